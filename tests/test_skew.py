"""A key holding a third of all rows: results stay right, plans stay split."""

from pyspark.sql import functions as F

from reelmart.operators.incremental import upsert
from reelmart.operators.windows import latest_per_key, sort_key, top_n_per_key, top_values


def _hot(spark, n=30_000):
    # key 0 holds a third of the rows; the rest are spread over 1,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("t"))


def test_hot_key_dedup_and_top_n(spark):
    df = _hot(spark)
    latest = {r.k: r.t for r in latest_per_key(df, ["k"], [sort_key("t", desc=True)]).collect()}
    assert latest[0] == max(i for i in range(30_000) if i % 3 == 0)
    top = top_n_per_key(df, ["k"], [sort_key("t", desc=True)], n=5)
    assert top.filter("k = 0").count() == 5
    plan = top._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_value_counts_and_upsert(spark):
    df = _hot(spark)
    assert top_values(df, "k", 1).first()["n"] == 10_000
    target = df.groupBy("k").agg(F.max("t").alias("t"))
    upd = spark.createDataFrame([(0, -1)], "k long, t long")
    merged = {r.k: r.t for r in upsert(target, upd, ["k"]).collect()}
    assert merged[0] == -1 and len(merged) == 1001
