"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a weight schedule over training time 0..1. Its
token target is its share of the budget, held to ``cap`` times its size with
the excess reshared by weight (water filling). Integrating the schedule gives
the source's cumulative token demand; a document that starts at cumulative
token ``c`` of its source is placed at the time when the demand reaches ``c``.
Past the source's size a second pass over its documents begins. Documents are
finally range-sorted by position.

Only ids, sources and sizes move. Cumulative sizes of a source are built from
65,536 hash slices per source, so the source that holds a third of all rows is
summed in slices, never in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelmart.llm._common import WORD, Shared, text_of

#: Weights by rank of the source, repeating.
WEIGHTS = (3, 1, 2)
#: Relative weight at equally spaced training times, per weight, repeating:
#: steady, rising, falling.
SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))
BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def demand_time(share: Column, schedule: Sequence[float]) -> Column:
    """The training time at which ``share`` (0..1) of the demand is consumed.

    The schedule is linear between its knots and is scaled to integrate to 1;
    each piece of the integral is a quadratic, inverted in closed form.
    """
    w = [float(x) for x in schedule]
    if len(w) < 2 or min(w) < 0 or sum(w) <= 0:
        raise ValueError("a schedule needs two or more weights, none below 0, not all 0")
    step = 1.0 / (len(w) - 1)
    area = [(a + b) / 2 * step for a, b in zip(w, w[1:])]
    total, done, out = sum(area), 0.0, F.lit(1.0)
    pieces = []
    for i, (a, b) in enumerate(zip(w, w[1:])):
        pieces.append((done / total, i * step, a / total, (b - a) / step / total))
        done += area[i]
    for start, t0, rate, slope in pieces:
        left = F.greatest(share - F.lit(start), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * left, F.lit(0.0)))
        took = F.when(left > 0, F.lit(2.0) * left / (F.lit(rate) + root)).otherwise(F.lit(0.0))
        here = F.lit(t0) + took
        out = here if start == 0 and t0 == 0 else F.when(share >= F.lit(start), here).otherwise(out)
    return out


def targets(sizes: DataFrame, share: tuple[int, int], cap: int, weights: Sequence[int]) -> DataFrame:
    """``source, source_size, weight, kind, target`` from ``source, source_size``.

    ``share``: the budget over the sum of all sizes, as a fraction. Sources are
    ranked by code point, null last. One row per source is ranked and
    cumulated in one window; documents never are.
    """
    up, down = share
    if cap * down < up:
        raise ValueError("the cap leaves less than the budget")
    kind = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = sizes.withColumn("kind", kind).withColumn(
        "weight", F.element_at(F.lit(list(weights)).cast("array<int>"), F.col("kind").cast("int") + 1))
    # the sources in the order in which a rising level fills them up
    order = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    size, weight = F.col("source_size").cast(BIG), F.col("weight").cast(BIG)
    zero = F.lit(0).cast(BIG)
    total = F.sum(size).over(whole)
    left = total * up - F.coalesce(F.sum(size).over(before), zero) * (cap * down)
    heavy = F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), zero)
    filled = ranked.withColumn("full", size * (cap * down) * heavy <= weight * left)
    full = F.col("full")
    rest = (F.sum(size).over(whole) * up
            - F.coalesce(F.sum(F.when(full, size)).over(whole), zero) * (cap * down)).cast("double")
    level = rest / (F.sum(F.when(~full, weight)).over(whole) * down).cast("double")
    target = F.when(full, (F.col("source_size") * cap).cast("double")) \
        .otherwise(F.col("weight").cast("double") * level)
    return filled.select("source", "source_size", "weight", "kind", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", share: tuple[int, int] = (3, 2), cap: int = 2,
        weights: Sequence[int] = WEIGHTS,
        schedules: Sequence[Sequence[float]] = SCHEDULES) -> DataFrame:
    """One row per document, range-sorted by its first position.

    Columns: ``id, source, size, source_size, target, taken, passes, position``.
    ``size`` counts words (null text: 0); ``taken`` is
    the number of words the mix takes, repeats counted; the last document of a
    source's demand is taken in part, so a source's taken words add up to its
    target rounded down. ``passes``: array of (pass, position, words), empty
    for a document that the mix leaves out, whose ``position`` is null and
    which sorts last. Order within a source is by the MD5 of the id, then
    size, so reruns agree; rows that repeat an id are documents of their own.
    Empty documents take no words and have no pass. An empty table gives none.
    """
    shared = Shared(docs.sparkSession, "mix")
    rank = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(text_of(text_col)).alias("size"),
        rank.alias("h"))
    rows = shared.table(rows.withColumn("slice", F.substring("h", 1, 4)), "sizes")

    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    per_source = slices.groupBy("source").agg(F.sum("n").alias("source_size"))
    aim = targets(per_source, share, cap, weights)
    lower = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    start = slices.withColumn("slice_at", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    start, aim = start.alias("s"), aim.alias("a")
    start = start.join(aim, F.col("s.source").eqNullSafe(F.col("a.source"))).select(
        F.col("s.source").alias("s_source"), F.col("s.slice").alias("s_slice"), "slice_at",
        "source_size", "target", "kind")

    inner = (W.partitionBy("source", "slice").orderBy("h", "size")
             .rowsBetween(W.unboundedPreceding, -1))
    at = F.col("slice_at") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    placed = (rows.join(start, F.col("source").eqNullSafe(F.col("s_source"))
                        & (F.col("slice") == F.col("s_slice")))
              .withColumn("at", at))
    quota = F.floor("target").cast("bigint")

    def words(k: int) -> Column:
        return F.greatest(F.lit(0), F.least(
            F.col("size"), quota - F.col("at") - F.col("source_size") * k)).cast("bigint")

    def time(k: int) -> Column:
        share_of = (F.col("at") + F.col("source_size") * k).cast("double") / F.col("target")
        out = None
        for i in range(len(weights)):
            t = demand_time(share_of, schedules[i % len(schedules)])
            out = t if out is None else F.when(F.col("kind") == i, t).otherwise(out)
        return out

    passes = F.filter(F.array(*[
        F.struct(F.lit(k + 1).alias("pass"), F.when(words(k) > 0, time(k)).alias("position"),
                 words(k).alias("words")) for k in range(cap)]), lambda p: p["words"] > 0)
    taken = sum((words(k) for k in range(1, cap)), words(0))
    return (placed.withColumn("passes", passes).select(
        "id", "source", "size", "source_size", "target", taken.alias("taken"), "passes",
        F.get("passes", F.lit(0))["position"].alias("position"), "h")
        .orderBy(F.col("position").asc_nulls_last(), "h").drop("h"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix in training order, whole, once per pass.

    A pass that takes less than half of a document's words leaves it out. Rows
    equal in id, source and size share one decision. Empty documents are left
    out, as they add no words.
    """
    plan = mix(docs, id_col, source_col, text_col, **options).filter(F.size("passes") > 0)
    plan = plan.groupBy("id", "source", "size").agg(F.max("passes").alias("passes"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("row_id"),
                       F.col(source_col).alias("row_source"), word_count(text_of(text_col)).alias("row_size"))
    on = F.col("row_id").eqNullSafe(F.col("id")) & F.col("row_source").eqNullSafe(F.col("source")) \
        & (F.col("row_size") == F.col("size"))
    out = rows.join(plan, on).select("row", "size", F.explode("passes").alias("p"))
    return (out.filter(F.col("p.words") * 2 >= F.col("size")).orderBy("p.position", "row." + id_col)
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
