"""Join helpers.

Broadcast is used only where the size is proven: a one-row aggregate (J3).
Everything else is left to Catalyst/AQE, which picks broadcast from runtime sizes and splits
skewed shuffle partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from reelmart.functions.columns import exact_mean


def with_global_mean(df: DataFrame, value: str, where: Column, name: str) -> DataFrame:
    """Add the mean of ``value`` over the rows matching ``where``.

    The mean is a one-row aggregate (partial + final, no hot group), so the
    broadcast nested-loop join is over exactly one row. An empty input gives
    a NULL mean and keeps every row.
    """
    kind = df.schema[value].dataType
    mean = exact_mean(value, kind.scale) if isinstance(kind, DecimalType) else F.avg(value)
    mean = df.filter(where).agg(mean.alias(name))
    return df.crossJoin(F.broadcast(mean))


def orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent row.

    The parent keys are de-duplicated first (partial aggregation); the
    anti-join is skew-safe under AQE (a hot child key is split).
    """
    keys = parent.select(F.col(parent_col).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    return (child.filter(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("__pk"), "left_anti"))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION`` (by column name, duplicates removed)."""
    return a.unionByName(b).distinct()
