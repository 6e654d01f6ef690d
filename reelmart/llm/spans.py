"""Pattern matches with code-point positions, in DataFrame functions only.

A text is split by a pattern and matched by it: the k-th match lies after the
k-th gap. Only the gaps' lengths and the characters next to each match leave
the scan, and positions are running sums over one text's matches. All patterns
are written so that a failing start costs a bounded number of steps, and
repeated groups are possessive, since Java's matcher recurses into others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Characters kept on either side of a match.
CONTEXT = 40


def found(text: Column, pattern: str, needs: str | None = None) -> Column:
    """array<struct<gap, match, before, after>> of all leftmost matches.

    ``needs``: a string that every match holds; texts without it skip the
    matcher.
    """
    p = F.lit(pattern)

    def zipped(gaps):
        return F.transform(
            F.regexp_extract_all(text, p, F.lit(0)),
            lambda m, i: F.struct(
                F.length(F.get(gaps, i)).alias("gap"), m.alias("match"),
                F.substring(F.get(gaps, i), F.lit(-CONTEXT), F.lit(CONTEXT)).alias("before"),
                F.substring(F.get(gaps, i + 1), F.lit(1), F.lit(CONTEXT)).alias("after")))

    # the outer lambda binds the gaps, so that a text is split once
    out = F.get(F.transform(F.array(F.split(text, pattern, -1)), zipped), F.lit(0))
    kind = "array<struct<gap:int,match:string,before:string,after:string>>"
    hit = F.contains(text, F.lit(needs)) if needs else F.regexp_like(text, p)
    return F.when(hit, out.cast(kind)).otherwise(F.array().cast(kind))


def candidates(rows: DataFrame, key: str, text: Column, patterns: Mapping[str, tuple[str, str | None]],
               keep: list[str]) -> DataFrame:
    """``keep`` columns, ``key`` and one array column per kind."""
    return rows.select(*keep, F.col(key), *[found(text, p, needs).alias(f"at_{k}")
                                            for k, (p, needs) in patterns.items()])


def positions(cands: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """``key, kind, start, end, match, before, after``, one row per match."""
    some = F.lit(False)
    for k in kinds:
        some = some | (F.size(f"at_{k}") > 0)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"at_{k}").alias("m"))
                               for k in kinds])).alias("e")
    rows = (cands.filter(some).select(key, each)
            .select(key, F.col("e.kind").alias("kind"), F.posexplode("e.m").alias("i", "m"))
            .select(key, "kind", "i", "m.*"))
    upto = W.partitionBy(key, "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(upto).cast("bigint")
    return (rows.withColumn("end", end)
            .select(key, "kind", (F.col("end") - F.length("match")).alias("start"), "end",
                    "match", "before", "after"))


def joined(order: list[str], which: Column) -> Column:
    """Aggregate: kind:start:end of the chosen spans by start, then kind."""
    rank = F.array_position(F.lit(order), F.col("kind"))
    item = F.struct(F.col("start"), rank.alias("rank"),
                    F.concat_ws(":", "kind", "start", "end").alias("span"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, item))),
                                    lambda s: s["span"]), ",")


def digest(spans: DataFrame, key: str, base: list[str], order: list[str]) -> DataFrame:
    """Per ``key``: n_<kind> and base_sha256 of base spans, spans of all.

    ``spans``: ``key, kind, start, end, is_base``; only kept spans. One text's
    spans meet in one row. Keys without spans are absent (see ``NO_SPANS``).
    """
    counts = [F.count(F.when((F.col("kind") == k) & F.col("is_base"), 1)).alias(f"n_{k}") for k in base]
    return (spans.groupBy(key).agg(*counts, joined(order, F.col("is_base")).alias("base"),
                                   joined(order, F.lit(True)).alias("spans"))
            .withColumn("base_sha256", F.sha2("base", 256)).drop("base"))


def with_digest(rows: DataFrame, digests: DataFrame, key: str, base: list[str]) -> DataFrame:
    """``rows`` joined with their digests; rows without spans get zeros."""
    out = rows.join(digests, key, "left")
    return out.withColumns(
        {f"n_{k}": F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("bigint")) for k in base}
        | {"base_sha256": F.coalesce(F.col("base_sha256"), F.sha2(F.lit(""), 256)),
           "spans": F.coalesce(F.col("spans"), F.lit(""))})
