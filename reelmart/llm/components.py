"""Connected components of a link table, without gathering any group.

Alternating large-star and small-star steps: every node's neighbours are
re-linked to the node's smallest neighbour until each component is one star.
Each step is a partial aggregate (minimum per node) and a join back on the
node, so a hub with a third of all links is pre-aggregated, and the join's
skewed side may be split. The number of steps grows with the logarithm of
the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reelmart.llm._common import Shared


def _lowest(e: DataFrame, shared: Shared) -> DataFrame:
    """``u, m``: the smallest neighbour of each node, as a table of its own.

    Joined back from a table, not from the aggregate itself, a hub's links may
    be split over several tasks.
    """
    return shared.table(e.groupBy("u").agg(F.min("v").alias("m")), "low")


def _large_star(e: DataFrame, shared: Shared) -> tuple[DataFrame, DataFrame]:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both, shared)
    return (both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .filter("u <> v")), low


def _small_star(e: DataFrame, shared: Shared) -> tuple[DataFrame, DataFrame]:
    low = _lowest(e, shared)
    hooked = (e.join(low, "u").filter("v <> m")
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return hooked.unionByName(low.select("u", F.col("m").alias("v"))), low


def components(links: DataFrame, shared: Shared) -> DataFrame:
    """``node, component`` for every node of ``links(u, v)``.

    ``component`` is the smallest node reachable. Null ends and loops are
    ignored; repeated links count once. An empty link table gives no rows.
    """
    e = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .filter("u is not null and v is not null and u <> v").distinct()
    now = shared.table(e, "links")
    before = None
    while True:
        seen = Observation()
        measure = [F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        big, low = _large_star(now, shared)
        big = shared.table(big.distinct(), "large")
        shared.drop(now, low)
        new, low = _small_star(big, shared)
        new = shared.table(new.distinct(), "small", (seen, measure))
        shared.drop(big, low)
        now, state = new, (seen.get["n"], seen.get["h"])
        if state == before or not state[0]:
            break
        before = state
    tips = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        tips.select("node", F.col("node").alias("component")))
