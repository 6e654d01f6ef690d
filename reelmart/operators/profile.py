"""Profiling operators F1-F5 as Spark jobs over whole tables.

Each profile is one aggregate pass (plus an exact median where asked);
values are unpivoted with ``inline`` inside the scan stage so the partial
aggregation runs before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from reelmart.operators.median import exact_median


@dataclass(frozen=True)
class Truthy:
    """A value that counts as present: not NULL, not 0, not '' and not false."""
    column: str


def truthy(column: str) -> Truthy:
    return Truthy(column)


def _resolve(df: DataFrame, rule) -> Column:
    if not isinstance(rule, Truthy):
        return rule
    c = F.col(rule.column)
    t = df.schema[rule.column].dataType
    if isinstance(t, NumericType):
        return c.isNotNull() & (c != 0)
    if isinstance(t, StringType):
        return c.isNotNull() & (c != "")
    if isinstance(t, BooleanType):
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def coverage(df: DataFrame, rules: Mapping[str, Column | Truthy]) -> DataFrame:
    """F1: one row per rule: ``rule, k, n, rate`` (rate 0.0 when n = 0)."""
    names = list(rules)
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count(F.when(_resolve(df, rules[r]), F.lit(1))).alias(f"__k{i}")
                      for i, r in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"__k{i}").alias("k"))
                     for i, r in enumerate(names)])
    out = counts.select("__n", F.inline(rows))
    return out.select("rule", "k", F.col("__n").alias("n"),
                      F.when(F.col("__n") == 0, F.lit(0.0))
                      .otherwise(F.col("k").cast("double") / F.col("__n")).alias("rate"))


def numeric_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """per column ``min, max, mean (1 dp), median (1 dp), n``.

    Zeros and NULLs are excluded; a column without values gets a row of
    NULLs. The median is exact and skew-safe (each column is one group).
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"),
                 F.nullif(F.col(c).cast("double"), F.lit(0.0)).alias("v")) for c in cols])))
    base = long.groupBy("field").agg(F.min("v").alias("min"), F.max("v").alias("max"),
                                     F.round(F.avg("v"), 1).alias("mean"),
                                     F.count("v").alias("n"))
    med = exact_median(long, ["field"], "v", "__med")
    return base.join(med, "field", "left").select(
        "field", "min", "max", "mean", F.round("__med", 1).alias("median"), "n")


def size_stats(sizes: DataFrame, col: str) -> DataFrame:
    """``min_size, median_size (truncated), max_size, parents`` of sizes."""
    base = sizes.agg(F.min(col).alias("min_size"), F.max(col).alias("max_size"),
                     F.count(F.lit(1)).alias("parents"))
    med = exact_median(sizes, [], col, "__med")
    return base.crossJoin(med).select(
        "min_size", F.floor("__med").cast("bigint").alias("median_size"), "max_size", "parents")


def fanout_stats(pairs: DataFrame, parent: str, value: str, other: DataFrame,
                 other_col: str) -> DataFrame:
    """distinct values, mean distinct values per parent (2 dp), and
    distinct values of a second list (one row)."""
    per_parent = pairs.groupBy(parent).agg(F.countDistinct(value).alias("__g"))
    a = pairs.agg(F.countDistinct(value).alias("distinct_values"))
    b = per_parent.agg(F.round(F.avg("__g"), 2).alias("avg_per_parent"))
    c = other.agg(F.countDistinct(other_col).alias("distinct_other"))
    return a.crossJoin(b).crossJoin(c)


def list_sizes(df: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """F4 for several lists at once: per list ``min_size, median_size
    (truncated), max_size, parents``. A missing list counts as empty."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("list"), F.coalesce(col, F.lit(0)).cast("long").alias("size"))
        for name, col in lists.items()])))
    base = long.groupBy("list").agg(F.min("size").alias("min_size"),
                                    F.max("size").alias("max_size"),
                                    F.count(F.lit(1)).alias("parents"))
    med = exact_median(long, ["list"], "size", "__med")
    return base.join(med, "list", "inner").select(
        "list", "min_size", F.floor("__med").cast("bigint").alias("median_size"), "max_size",
        "parents")
