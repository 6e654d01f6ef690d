"""The payload adapter: bounded lists, whole totals, plans that prune."""

import re

from pyspark.sql import functions as F

from conftest import SF001
from reelmart.plans import derive, marts
from reelmart.plans.mart_queries import world


def _hot_copy(spark, scratch):
    """The tables with one order that holds a third of all lines."""
    for t in ("orders", "supplier", "nation", "part", "customer"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    key = li.agg(F.min("l_orderkey").alias("k")).first().k
    li.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64(*li.columns), F.lit(3)) == 0, F.lit(key))
                  .otherwise(F.col("l_orderkey"))).write.parquet(f"{scratch}/lineitem.parquet")
    return key


def test_hot_order_keeps_the_totals(spark, scratch):
    key = _hot_copy(spark, scratch)
    li, orders = (spark.read.parquet(f"{scratch}/{t}.parquet") for t in ("lineitem", "orders"))
    assert li.filter(F.col("l_orderkey") == key).count() > li.count() / 4
    fact = world(spark, scratch)["fact_movie"]
    got = fact.agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("rev"), F.sum("budget").alias("budget"),
                   F.sum("runtime_min").alias("lines")).first()
    want = orders.agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("rev")).first()
    lines = li.agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    assert (got.n, got.rev, got.budget, got.lines) == (want.n, want.rev, lines.b, lines.n)
    sizes = derive.order_cells(spark, scratch).groupBy("l_orderkey").count()
    assert sizes.agg(F.max("count")).first()[0] <= 625
    cast = world(spark, scratch)["int_movie_cast"].filter(F.col("movie_id") == key)
    assert cast.count() == 10  # of many more cells


def test_cast_cap_is_reached_on_the_given_tables(spark):
    credits = world(spark, SF001)["stg_credits"]
    from reelmart.functions.payload import array_size
    assert credits.filter(array_size(F.col("cast_list")) > 10).count() > 0


def _scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_plans_are_lazy_and_prune(spark):
    genre = world(spark, SF001)["dim_genre"]
    plan = genre._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "ExistingRDD" not in plan
    assert "l_shipdate" not in plan and "s_acctbal" not in plan and "p_retailprice" not in plan
    roi = world(spark, SF001, "stg_movie_details")["agg_genre_roi"]
    plan = roi._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "ExistingRDD" not in plan and "overview" not in plan


def test_trends_read_fact_and_snapshot_twice_at_most(spark):
    fact = spark.createDataFrame([(1, "a", 1, 2.0, 99)], "movie_id long, title string, budget long, popularity double, vote_count long")
    snap = spark.createDataFrame([(1, 1.0)], "movie_id long, popularity double").selectExpr(
        "movie_id", "date '2026-01-01' AS snapshot_date", "popularity", "1.0 AS vote_average", "1 AS vote_count",
        "1 AS revenue", "false AS is_synthetic")
    plan = marts.daily_movie_trends(fact, snap)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 4


def test_imdb_ids_of_long_keys_stay_apart(spark, scratch):
    for t in ("lineitem", "supplier", "nation", "part", "customer"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    (spark.read.parquet(f"{SF001}/orders.parquet").limit(20)
     .withColumn("o_orderkey", F.col("o_orderkey") + F.lit(123456789000))
     .write.parquet(f"{scratch}/orders.parquet"))
    assert world(spark, scratch)["fact_movie"].select("imdb_id").distinct().count() == 20


def test_payload_explode_returns_every_line_of_a_hot_order(spark, scratch):
    from reelmart.plans.queries import PART_LINES, QUERIES, line_documents
    key = _hot_copy(spark, f"{scratch}/hot")
    li = spark.read.parquet(f"{scratch}/hot/lineitem.parquet")
    odd = li.limit(3).withColumns({"l_orderkey": F.lit(None).cast("long"), "l_partkey": F.lit(-1).cast("long"),
                                   "l_suppkey": F.lit(None).cast("long")})  # no such part, supplier or order
    li.unionByName(odd).write.parquet(f"{scratch}/lineitem.parquet")
    li = spark.read.parquet(f"{scratch}/lineitem.parquet")
    want = sorted(map(repr, li.selectExpr("l_orderkey", "cast(l_linenumber as long)", "l_partkey",
                                          "l_quantity").toPandas().itertuples(index=False, name=None)))
    got = QUERIES["payload_explode"](spark, scratch).select("order_id", "line_no", "part_key", "quantity")
    assert sorted(map(repr, got.toPandas().itertuples(index=False, name=None))) == want
    sizes = line_documents(li).select("id", F.size("lines").alias("n"))
    assert sizes.filter(F.col("id") == key).count() > 10 and sizes.agg(F.max("n")).first()[0] < 3 * PART_LINES


def test_cast_lists_are_not_dealt_by_customer(spark):
    """Only narrow orders and customers meet by customer; the lists follow by order."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = derive.raw_credits(spark, SF001)._jdf.queryExecution().optimizedPlan()
        node = plan
        while "Join" not in node.nodeName():
            node = node.children().apply(0)
        assert "c_custkey" not in node.condition().toString() and "l_orderkey" in node.condition().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_model_is_stored_with_the_columns_that_its_plans_read(spark):
    from reelmart.plans import mart_queries as m
    w = m.world(spark, SF001, *m.TALENT)
    assert w["fact_movie"].columns == ["movie_id", "revenue", "vote_average", "vote_count"]
    assert "department" not in w["int_movie_cast"].columns
    assert m.world(spark, SF001)["fact_movie"].columns == m.marts.FACT_COLUMNS


def test_medians_read_rows_apart_from_their_joins(spark):
    """The joins and the counting of values do not add up in one task."""
    w = world(spark, SF001)
    assert "RebalancePartitions" in w["agg_genre_roi"]._jdf.queryExecution().optimizedPlan().toString()


def test_orders_are_dealt_into_more_parts_the_larger_the_tables(spark, monkeypatch):
    """the parts of the payload stage follow the bytes of the tables, not the session alone."""
    d = "/root/testdata/sf0.001"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert derive.order_parts(spark, d) == 1
    few = {(str(r.raw_payload), r.ingested_at, r.payload_hash) for r in derive.raw_movie_details(spark, d).collect()}
    monkeypatch.setattr(derive, "PART_BYTES", 3000)
    parts = derive.order_parts(spark, d)
    assert parts > 2 * least
    for made in (derive.raw_movie_details, derive.raw_credits):
        plan = made(spark, d)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {parts}\), REPARTITION", plan)
    many = {(str(r.raw_payload), r.ingested_at, r.payload_hash) for r in derive.raw_movie_details(spark, d).collect()}
    assert many == few


def test_stored_models_shuffle_into_parts_by_size(spark, scratch):
    """the shuffles of a stored model follow the tables; the session keeps its own number."""
    from reelmart.sources.tables import write_once
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(5000).groupBy((F.col("id") * 7).alias("k")).count()
        out = write_once(rows, "t", int(before) + 30)
        files = out.selectExpr("input_file_name() AS f").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert files == int(before) + 30 and out.count() == 5000
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_hot_order_keeps_the_totals_in_many_parts(spark, scratch, monkeypatch):
    """cells summed by slices and dealt by order hold the same totals."""
    monkeypatch.setattr(derive, "PART_BYTES", 20_000)
    test_hot_order_keeps_the_totals(spark, scratch)


def test_every_model_that_is_read_twice_is_stored_once(spark):
    """a payload read by one model is part of that model's plan."""
    from reelmart.plans import mart_queries as m
    assert "raw_credits" not in m.EVERY and "cells" not in m.EVERY and "cell_lists" in m.EVERY
    assert set(m.EVERY) | {"raw_credits", "cells", "snapshot_seed"} == set(m.MODELS)


def test_stored_payloads_are_kept_in_one_piece_where_asked(spark):
    """taking payloads apart and putting them together costs more than reading them."""
    from glob import glob

    import pyarrow.parquet as pq

    from reelmart.sources.tables import SHREDDING, write_once
    df = spark.range(20).select(F.to_variant_object(F.struct("id", F.lit("x").alias("name"))).alias("v"))
    before = spark.conf.get(SHREDDING)
    out = write_once(df, "plain", shredded=False)
    assert spark.conf.get(SHREDDING) == before
    path = out.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "").replace("file:", "")
    assert all("typed_value" not in str(pq.read_schema(f)) for f in glob(f"{path}/*.parquet"))
    assert sorted(str(r.v) for r in out.collect()) == sorted(str(r.v) for r in df.collect())


def test_lists_of_cells_serve_both_payloads(spark):
    """the cells of an order are gathered once, and both payloads are as from the cells."""
    from reelmart.plans import mart_queries as m
    rows = lambda df: sorted((str(r.raw_payload), r.ingested_at, r.payload_hash) for r in df.collect())
    w = m.world(spark, SF001, "cell_lists")
    for made, name in ((derive.raw_movie_details, "raw_movie_details"), (derive.raw_credits, "raw_credits")):
        assert rows(w[name]) == rows(made(spark, SF001))
        assert "Aggregate" not in w[name]._jdf.queryExecution().optimizedPlan().toString()
