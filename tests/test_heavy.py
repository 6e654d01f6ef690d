"""Exact most common values by bucket counts."""

import pytest
from pyspark.sql import functions as F

from reelmart.operators.heavy import heavy_values
from reelmart.operators.windows import top_values


def _skewed(spark, n=200_000, distinct=50_000):
    """A third of the rows in value 0, some common values, the rest nearly flat."""
    i = F.col("id")
    return spark.range(n).select(F.when(i % 3 == 0, F.lit(0)).when(i % 3 == 1, i % 90 + 1)
                                 .otherwise(i % distinct + 1000).cast("long").alias("v"))


@pytest.mark.parametrize("n", [1, 5, 31, 40])
@pytest.mark.parametrize("width", [1, 64, 4096])
def test_equals_counting_every_value(spark, n, width):
    df = _skewed(spark, 30_000, 5_000)
    assert heavy_values(df, "v", n, width=width).collect() == top_values(df, "v", n).collect()


@pytest.mark.parametrize("rows", [1, 3])
def test_flat_ties_and_strings(spark, rows):
    df = spark.range(3_000).select((F.col("id") % 1000).cast("string").alias("v"))
    assert heavy_values(df, "v", 7, rows=rows, width=128).collect() == top_values(df, "v", 7).collect()


def test_nulls_empty_and_fewer_values(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("",), (None,), (None,)], "v string")
    assert [tuple(r) for r in heavy_values(df, "v", 10).collect()] == [("", 1), ("a", 1), ("b", 1)]
    assert heavy_values(df.limit(0), "v", 10).count() == 0
    assert heavy_values(df.select(F.lit(None).cast("string").alias("v")), "v", 3).count() == 0


def test_few_values_are_shuffled(spark):
    """Of 50,000 rare values, the last aggregate sees those that share a full bucket twice."""
    df = _skewed(spark)
    out = heavy_values(df, "v", 31)
    assert out.collect() == top_values(df, "v", 31).collect()
    plan = out._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Aggregate":  # sort and limit lie above it
        plan = plan.children().head()
    from pyspark.sql import DataFrame
    jvm = spark._jvm
    seen = DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark).count()
    assert seen < 1000
