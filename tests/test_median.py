import random
import statistics

from pyspark.sql import functions as F

from reelmart.operators.median import exact_median, exact_medians


def _brute(rows):
    out = {}
    for g, v in rows:
        out.setdefault(g, [])
        if v is not None:
            out[g].append(v)
    return {g: (statistics.median(vs) if vs else None) for g, vs in out.items()}


def test_exact_median_small_groups(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 10.0), ("b", 4.0), ("b", 5.0), ("c", None),
            ("d", 3.0), ("d", 3.0), ("d", 3.0), ("d", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()}
    assert got == _brute(rows)


def test_exact_median_narrowing_rounds(spark):
    # force the narrowing path: tiny bucket bound, one hot group holding most rows
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 5000))) for _ in range(6000)]
    rows += [("hot", 42.0)] * 2000 + [("cold", float(i)) for i in range(11)]
    rows += [("even", 1.0), ("even", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", fanout=8).collect()}
    assert got == _brute(rows)


def test_exact_median_global_and_multi(spark):
    rows = [(i % 3, float(i), float(-i)) for i in range(101)]
    df = spark.createDataFrame(rows, "g long, x double, y double")
    glob = exact_median(df, [], "x", "m").first()["m"]
    assert glob == 50.0
    multi = {r.g: (r.mx, r.my) for r in exact_medians(df, ["g"], {"mx": "x", "my": "y"}).collect()}
    for g in range(3):
        xs = [float(i) for i in range(101) if i % 3 == g]
        assert multi[g] == (statistics.median(xs), -statistics.median(xs))


def test_exact_median_null_keys(spark):
    rows = [(None, "a", 4.0), (None, "a", 6.0), ("x", None, 1.0), (None, None, 7.0), (None, None, None), ("x", "y", None)]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    got = {(r.g, r.h): r.m for r in exact_median(df, ["g", "h"], "v", "m").collect()}
    assert got == {(None, "a"): 5.0, ("x", None): 1.0, (None, None): 7.0, ("x", "y"): None}


def test_exact_median_is_lazy(spark):
    """Building the plan runs no job, and the scan stays in it."""
    df = spark.range(100).selectExpr("id % 3 AS g", "id * 1.0 AS v")
    plan = exact_median(df, ["g"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" in plan and "RDD" not in plan


def test_exact_median_scans_its_input_once(spark, tmp_path):
    """All reads of the pairs share one exchange, groups broadcast or not."""
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("if(id % 3 = 0, 0, id % 500) AS g", "if(id % 11 = 0, null, id * 7 % 1009 * 1.0) AS v") \
        .write.parquet(path)
    want = {r.g: r.m for r in spark.read.parquet(path).groupBy("g").agg(F.expr("median(v)").alias("m")).collect()}
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            df = exact_median(spark.read.parquet(path), ["g"], "v", "m")
            assert {r.g: r.m for r in df.collect()} == want
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        final = plan.split("== Initial Plan ==")[0]
        # reused stages print their plan again; what is not reused is run
        assert final.count("ReusedExchange") >= 2, final


def test_exact_median_hot_group_is_split(spark):
    """With groups too many to broadcast, the hot group's part of the join is split."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    df = spark.range(300_000).selectExpr("if(id % 3 = 0, -1, id % 20000) AS g", "id * 1.0 AS v")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        med = exact_median(df, ["g"], "v", "m")
        got = {r.g: r.m for r in med.collect()}
        plan = med._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 20001 - sum(all(i % 3 == 0 for i in range(g, 300_000, 20000)) for g in range(20000))
    assert got[-1] == statistics.median(range(0, 300_000, 3))
    assert "skew=true" in plan.split("== Initial Plan ==")[0]
