from pyspark.sql import functions as F

from reelmart.operators.windows import (dense_top_n, flag_rank_top_n, latest_per_key, rank_top_n,
                                        sort_key, top_n_per_key, top_values, with_rank)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_and_plan(spark):
    # FIXTURES 4.5: the later load wins
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c")], "k long, t long, v string")
    out = latest_per_key(df, ["k"], [sort_key("t", desc=True)], [F.col("v").asc()])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "b"), (2, 5, "c")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    # a partial group limit runs before the shuffle: a hot key ships <= n rows per map task
    assert plan.count("WindowGroupLimit") >= 2


def test_top_n_rounded_popularity(spark):
    # FIXTURES 4.6: 5.4 (order 1) and 5.3 (order 0) both round to 5; order 0 first; 10 kept
    rows = [(1, 5.4, 1, "p1"), (1, 5.3, 0, "p0")] + [(1, 1.0, i, f"x{i}") for i in range(2, 12)]
    df = spark.createDataFrame(rows, "m long, pop double, ord long, who string")
    top = top_n_per_key(df, ["m"], [sort_key(F.col("pop").cast("decimal(38,0)"), desc=True),
                                    sort_key("ord", nulls_first=False)],
                        [F.col("who").asc()], 10).orderBy(F.col("pop").cast("decimal(38,0)").desc(),
                                                          "ord")
    got = [r["who"] for r in top.collect()]
    assert len(got) == 10 and got[:2] == ["p0", "p1"]


def test_null_popularity_ranks_first(spark):
    # FIXTURES 4.23
    df = spark.createDataFrame([(1, None, "n"), (1, 3.0, "a")], "m long, pop double, who string")
    first = latest_per_key(df, ["m"], [sort_key("pop", desc=True, nulls_first=True)])
    assert first.first()["who"] == "n"
    last = latest_per_key(df, ["m"], [sort_key("pop", desc=True, nulls_first=False)])
    assert last.first()["who"] == "a"


def test_dense_and_rank_top_n_match_window(spark):
    # FIXTURES 4.20: ties at the cut are all kept
    vals = [10.0, 9.0, 9.0, 8.0, 7.0, 7.0, 7.0, None, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    from pyspark.sql import Window
    for n in range(1, 8):
        for desc in (True, False):
            for nf in (True, False):
                o = sort_key("v", desc, nf)
                ref_d = {r.id for r in df.withColumn("r", F.dense_rank().over(Window.orderBy(o)))
                         .filter(f"r <= {n}").collect()}
                ref_r = {r.id for r in df.withColumn("r", F.rank().over(Window.orderBy(o)))
                         .filter(f"r <= {n}").collect()}
                assert {r.id for r in dense_top_n(df, "v", n, desc, nf).collect()} == ref_d
                assert {r.id for r in rank_top_n(df, "v", n, desc, nf).collect()} == ref_r
                flagged = {r.id for r in flag_rank_top_n(df, "v", n, "f", desc, nf).collect() if r.f}
                assert flagged == ref_r
                ranked = {(r.id, r.rank) for r in with_rank(df, "v", n, "rank", desc, nf).collect()}
                ref = {(r.id, r.r) for r in df.withColumn("r", F.rank().over(Window.orderBy(o)))
                       .filter(f"r <= {n}").collect()}
                assert ranked == ref


def test_dense_top_n_has_no_global_window(spark):
    df = spark.range(1000).select("id", (F.col("id") % 37).cast("double").alias("v"))
    plan = _plan(dense_top_n(df, "v", 5))
    assert "Window " not in plan.replace("WindowGroupLimit", "")


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert dense_top_n(df, "v", 3).count() == 0
    assert flag_rank_top_n(df, "v", 3, "f").count() == 0


def test_top_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in top_values(df, "x", 2).collect()] == [("b", 2), ("c", 2)]


def test_ordered_multi_key_nulls_last(spark):
    # Order by year asc, ratio desc nulls last
    from reelmart.operators.windows import ordered
    df = spark.createDataFrame([(2020, None), (2019, 1.0), (2020, 3.0), (2020, 2.0)],
                               "y long, r double")
    got = [tuple(r) for r in ordered(df, sort_key("y"), sort_key("r", desc=True,
                                                                 nulls_first=False)).collect()]
    assert got == [(2019, 1.0), (2020, 3.0), (2020, 2.0), (2020, None)]
