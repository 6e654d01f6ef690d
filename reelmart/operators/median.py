"""A5: exact median per group that stays skew-safe and lazy.

Spark's built-in ``median`` merges, for each group, a map of every distinct
value in one task: a group holding a third of the rows would be held whole
by one executor. This operator finds the middle value(s) in one lazy plan:

1. (group, value) pairs are counted, which spreads a hot group over all
   partitions by the value;
2. per group: the number of values, hence the middle ranks, and up to
   ``fanout`` approximate quantiles (a mergeable sketch of bounded size);
3. the quantiles cut a group's values into slices; slice counts are algebraic
   and tell which one or two slices hold the middle ranks;
4. only the values in the range of those slices are ordered, about one in
   ``fanout`` of a group's distinct values, with a running count that pins both middles.

The pairs are read three times, always whole and with the same columns, so that
Spark scans the input once and reuses the exchange. Where the groups are too
many to broadcast, the pairs meet them by a shuffle join. Its key is a struct of
the group, and what follows is keyed by a struct of (group, slice): partitioning
by the group serves neither, so an exchange stands before and behind the join
and adaptive execution may split a hot group's part of it.

The result is exact whatever the sketch returned, since its quantiles only
choose where to cut. It equals the interpolated median, written as
``lo + (hi - lo) * 0.5``; NULL values are ignored, a group with only NULLs gets
NULL, and NULL keys are a group like any other (groups travel as one struct,
whose equality takes NULL fields as equal).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A value is placed among the cuts by whole steps of so many, then one by one.
STEP = 8


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median",
                 fanout: int = 64) -> DataFrame:
    """One row per group of ``keys`` (groups with only NULLs included).

    Without keys there is one group; an empty ``df`` then gives no row.
    """
    keys = list(keys)
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("__all"))
    counts = (df.select(group.alias("__g"), F.col(value).cast("double").alias("__v"))
              .groupBy("__g", "__v").agg(F.count(F.lit(1)).alias("__c")))
    known = F.col("__v").isNotNull()
    probs = [i / fanout for i in range(1, fanout)]
    groups = counts.groupBy("__g").agg(
        F.coalesce(F.sum(F.when(known, F.col("__c"))), F.lit(0)).alias("__n"),
        F.percentile_approx("__v", probs, 10 * fanout).alias("__cuts"))
    groups = groups.withColumn("__steps", F.filter("__cuts", lambda p, i: (i + 1) % STEP == 0))
    # slice: how many of the ascending cuts lie below the value, found by steps;
    # NULLs stay, so that all reads of the pairs are alike, and count for nothing
    below = lambda cuts: F.coalesce(F.size(F.filter(cuts, lambda p: p < F.col("__v"))), F.lit(0))
    steps = F.when(known, below(F.col("__steps"))).otherwise(0) * STEP
    slice_ = F.struct("__g", (steps + F.when(known, below(F.slice("__cuts", steps + 1, F.lit(STEP)))).otherwise(0))
                      .alias("__s")).alias("__gs")
    weight = F.when(known, F.col("__c")).otherwise(0).alias("__c")
    pairs = counts.withColumn("__k", F.struct("__g"))
    by_key = lambda df: df.withColumn("__k", F.struct("__g")).drop("__g")
    slices = (pairs.join(by_key(groups), "__k").select(slice_, weight, "__n")
              .groupBy("__gs").agg(F.sum("__c").alias("__sc"), F.max("__n").alias("__n"))
              .select("__gs.*", "__sc", "__n"))
    upto = Window.partitionBy("__g").orderBy("__s").rowsBetween(Window.unboundedPreceding, 0)
    lo, hi = F.expr("(__n + 1) div 2"), F.expr("__n div 2 + 1")
    slices = (slices.withColumn("__end", F.sum("__sc").over(upto))
              .withColumn("__start", F.col("__end") - F.col("__sc")))
    holds = lambda k: (F.col("__start") < k) & (k <= F.col("__end"))
    # the one or two slices (no value lies between them) are one range of values
    kept = slices.filter(holds(lo) | holds(hi) | (F.col("__n") == 0)).groupBy("__g").agg(
        F.min("__s").alias("__s"), F.max("__s").alias("__last"), F.min("__start").alias("__from"))
    ranges = groups.join(kept, "__g").select(
        "__g", "__n", "__s", "__from", F.get("__cuts", F.col("__s") - 1).alias("__above"),
        F.get("__cuts", F.col("__last")).alias("__upto"))
    inside = ((F.col("__above").isNull() | (F.col("__v") > F.col("__above")))
              & (F.col("__upto").isNull() | (F.col("__v") <= F.col("__upto"))))
    within = Window.partitionBy("__gs").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    run = (pairs.join(by_key(ranges), "__k").filter(inside)
           .select(F.struct("__g", "__s").alias("__gs"), "__v", weight, "__n", "__from")
           .withColumn("__end", F.col("__from") + F.sum("__c").over(within))
           .withColumn("__start", F.col("__end") - F.col("__c")))
    picked = run.groupBy(F.col("__gs")["__g"].alias("__g")).agg(
        F.max(F.when(holds(lo), F.col("__v"))).alias("__lo"), F.max(F.when(holds(hi), F.col("__v"))).alias("__hi"))
    median = (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.lit(0.5)).alias(name)
    return picked.select(*[F.col("__g")[k].alias(k) for k in keys], median)


def exact_medians(df: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Several exact medians per group in one pass: the value columns are
    unpivoted (``inline`` in the scan stage) and selected together.

    ``values`` maps output name -> input column. One row per group.
    """
    keys = list(keys)
    long = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("__m"), F.col(col).cast("double").alias("__x"))
        for name, col in values.items()])))
    med = exact_median(long, [*keys, "__m"], "__x", "__med")
    return med.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__m") == name, F.col("__med"))).alias(name) for name in values])
