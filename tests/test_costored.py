"""Co-stored tables: joins on the key without a shuffle, hot keys beside them."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from reelmart.plans import marts
from reelmart.plans.mart_queries import world
from reelmart.sources.costored import CoStored


def _final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture()
def shuffled_joins(spark):
    """No side is broadcast on its own, as at scale."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def test_join_without_exchange(spark, scratch, shuffled_joins):
    co = CoStored(spark, "k", buckets=4, path=scratch)
    co.put("a", spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a")))
    co.put("b", spark.range(3000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("b")))
    assert not co.hot_keys("a") and not co.hot_keys("b")
    out = co.join("a", "b")
    assert "Exchange" not in _final(out)
    assert out.count() == 2000 and out.filter("a != 2 * k").count() == 0
    both = co.frame("a").join(co.frame("b"), "k").groupBy("k").count()
    assert "Exchange" not in _final(both) and both.count() == 1000


def test_hot_key_is_split_and_joined(spark, scratch, shuffled_joins):
    """A third of all rows, and of them NULL keys, under one key."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 30 == 1, F.lit(None))
        .otherwise(F.col("id") % 1000 + 8).cast("long").alias("k"), F.col("id").alias("v"))
    co = CoStored(spark, "k", buckets=16, path=scratch)
    co.put("rows", rows)
    co.put("names", spark.range(1200).select(F.col("id").alias("k"), F.lit("n").alias("n")))
    assert co.hot_keys("rows") == [7] and co.hot_keys("names") == []
    got = co.join("rows", "names").groupBy("k").count().collect()
    want = rows.filter("k is not null").groupBy("k").count().collect()
    assert sorted(got) == sorted(want)
    # the level part is not exchanged, and the frame of a table with a hot key is a plain scan
    level = co.join("rows", "names")._jdf.queryExecution().sparkPlan().toString()
    assert "Bucketed: true" in level
    assert co.frame("rows").count() == rows.count()
    assert "Bucketed: true" not in co.frame("rows")._jdf.queryExecution().executedPlan().toString()


def test_empty_and_replaced(spark, scratch):
    co = CoStored(spark, "k", buckets=4, path=scratch)
    assert co.put("a", spark.createDataFrame([], "k long, a string")).count() == 0
    co.put("b", spark.createDataFrame([(1, "x"), (None, "y")], "k long, b string"))
    assert co.join("a", "b").count() == 0
    co.put("a", spark.createDataFrame([(1, "z"), (None, "w")], "k long, a string"))
    assert [tuple(r) for r in co.join("a", "b").collect()] == [(1, "z", "x")]


@pytest.mark.parametrize("mart", ["trends", "roi", "evolution"])
def test_marts_over_co_stored_models(spark, mart, shuffled_joins):
    """M13, M14 and M17 read the stored models without an exchange by movie."""
    w = world(spark, SF001, "cells", "stg_movie_details", "raw_movie_details")
    co = CoStored(spark, "movie_id", buckets=8)
    fact = co.put("fact", w["fact_movie"])
    if mart == "trends":
        out = marts.daily_movie_trends(fact, co.put("snapshot", w["fact_movie_snapshot"]))
    else:
        bridge, genres = co.put("genres", w["bridge_movie_genre"]), F.broadcast(w["dim_genre"])
        out = (marts.agg_genre_roi if mart == "roi" else marts.agg_genre_evolution)(fact, bridge, genres)
    assert "hashpartitioning(movie_id" not in _final(out)
