"""Set operations and re-aggregation (U3, A10; U1/U2 are ``unionByName``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.operators.joins import union_distinct

__all__ = ["union_distinct", "reaggregate_mean"]


def reaggregate_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """A10: unweighted mean of already-aggregated values (e.g. monthly means
    averaged per year: each month counts once, whatever its size)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name))
