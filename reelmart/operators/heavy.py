"""Exact most common values without shuffling every distinct value.

``windows.top_values`` counts every distinct value, so its shuffle grows with
them. ``heavy_values`` first counts rows per hash bucket, in ``rows`` tables of
``width`` buckets with different seeds: after partial aggregation at most
``rows * width`` numbers leave a task. A value cannot occur more often than its
bucket in any table (a count-min sketch), so

1. the values of the ``n`` fullest buckets of the first table are counted
   exactly; the n-th of these counts is a floor for the answer;
2. values with a bucket below the floor in some table are out, all others are
   counted exactly.

The answer is exact for every distribution. With few common values, only they
and the values that share all their buckets are shuffled; if all values are
about equally common, the floor excludes little and every value is counted, as
``top_values`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.sources.tables import write_once


def _bucket(col: str, seed: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(width)).cast("int")


def heavy_values(df: DataFrame, col: str, n: int = 10, count_name: str = "n",
                 width: int = 1 << 16, rows: int = 2) -> DataFrame:
    """The ``n`` most common values of ``col``, ties by value, as ``top_values``.

    NULL is not a value. ``df`` is read three times, its column ``col`` only;
    the bucket counts (at most ``rows * width`` rows) are stored in between.
    """
    values = df.filter(F.col(col).isNotNull()).select(col)
    tables = F.array(*[F.struct(F.lit(s).alias("of"), _bucket(col, s, width).alias("bucket")) for s in range(rows)])
    sketch = write_once(values.select(F.inline(tables)).groupBy("of", "bucket")
                        .agg(F.count(F.lit(1)).alias("held")), "buckets")

    def counted(kept: DataFrame) -> DataFrame:
        return kept.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))

    fullest = sketch.filter("of = 0").orderBy(F.col("held").desc(), F.col("bucket")).limit(n).select("bucket")
    first = counted(_among(values, col, 0, width, fullest))
    # one row; buckets that hold fewer than n values in all exclude nothing
    floor = (first.orderBy(F.col(count_name).desc()).limit(n)
             .agg(F.when(F.count(F.lit(1)) == n, F.min(count_name)).otherwise(F.lit(1)).alias("floor")))
    full = write_once(sketch.join(F.broadcast(floor), F.col("held") >= F.col("floor"), "inner")
                      .select("of", "bucket"), "full-buckets")
    kept = values
    for s in range(rows):
        kept = _among(kept, col, s, width, full.filter(F.col("of") == s).select("bucket"))
    return counted(kept).orderBy(F.col(count_name).desc(), F.col(col).asc()).limit(n)


def _among(values: DataFrame, col: str, seed: int, width: int, buckets: DataFrame) -> DataFrame:
    """Values in ``buckets`` (at most ``width`` integers, so they are broadcast)."""
    wanted = buckets.withColumnRenamed("bucket", "__bucket")
    return values.join(F.broadcast(wanted), _bucket(col, seed, width) == F.col("__bucket"), "left_semi")
