"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import os
import sys

from conftest import SF001

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final (AQE) plan
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scan_pruning_and_pushdown(spark):
    df = E.queries()["tier_outcomes"](spark, SF001)
    text = _formatted(df)
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text
    # only the two needed lineitem columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_partial_group_limit_before_shuffle(spark):
    plan = E.queries()["top_lines"](spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    lines = [ln for ln in plan.splitlines() if "WindowGroupLimit" in ln]
    assert len(lines) == 2  # partial (map side) + final


def test_dense_rank_is_bounded_top_k(spark):
    plan = _plan(E.queries()["dense_top"](spark, SF001))
    assert "TakeOrderedAndProject" in plan
    assert "BroadcastNestedLoopJoin" in plan  # one-row threshold


def test_partial_aggregation(spark):
    plan = _plan(E.queries()["nation_year_star"](spark, SF001))
    assert "HashAggregate" in plan and "partial_" in plan


def test_upsert_broadcasts_small_updates(spark):
    from pyspark.sql import functions as F

    from reelmart.operators.incremental import upsert
    big = spark.range(0, 200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = spark.range(0, 100).select((F.col("id") * 7).alias("k"), F.lit(-1).alias("v"))
    plan = _plan(upsert(big, small, ["k"]))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan  # target scanned, not shuffled
