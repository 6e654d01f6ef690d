"""Window-style operators.

Scale notes
-----------
* Per-key ``row_number() <= n`` (W1-W4, T3) is planned by Spark as a
  partial ``WindowGroupLimit`` *before* the shuffle and a final one after it,
  so a hot key sends at most ``n`` rows per map partition across the
  network: a key holding a third of the rows does not land in one task.
  Every order gets a total tiebreak so results are deterministic.
* Global ``rank``/``dense_rank`` filters (W5, W6) are not run as an
  un-partitioned window (that would move every qualifying row through one
  task). Instead a bounded top-n (at most ``n`` rows or ``n`` distinct values)
  yields a one-row threshold, which is broadcast (size 1) and applied as a
  filter on all partitions in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"
_THR = "__thr"


def sort_key(col, desc: bool = False, nulls_first: bool | None = None) -> Column:
    """An explicit sort key; NULL placement is always spelled out."""
    c = F.col(col) if isinstance(col, str) else col
    if nulls_first is None:
        nulls_first = desc  # warehouse default: NULL is the largest value
    if desc:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  tiebreak: Sequence[Column] = (), n: int = 1) -> DataFrame:
    """At most ``n`` rows per key, first by ``order`` then ``tiebreak``."""
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return (df.withColumn(_RN, F.row_number().over(w))
            .filter(F.col(_RN) <= n).drop(_RN))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Exactly one row per key (the first by ``order``)."""
    return top_n_per_key(df, keys, order, tiebreak, 1)


def _at_least_as_good(x: Column, t: Column, desc: bool, nulls_first: bool) -> Column:
    better = (x >= t) if desc else (x <= t)
    if nulls_first:
        return x.isNull() | (t.isNotNull() & better)
    return t.isNull() | (x.isNotNull() & better)


def _threshold(col: str, top: DataFrame, desc: bool, nulls_first: bool) -> DataFrame:
    """One-row frame holding the worst value of a bounded top-n (none if empty)."""
    worst = top.orderBy(sort_key(col, not desc, not nulls_first)).limit(1)
    return F.broadcast(worst.select(F.col(col).alias(_THR)))


def _threshold_filter(df: DataFrame, col: str, top: DataFrame, desc: bool,
                      nulls_first: bool) -> DataFrame:
    return (df.crossJoin(_threshold(col, top, desc, nulls_first))
            .filter(_at_least_as_good(F.col(col), F.col(_THR), desc, nulls_first))
            .drop(_THR))


def dense_top_n(df: DataFrame, col: str, n: int, desc: bool = True,
                nulls_first: bool | None = None, among: DataFrame | None = None) -> DataFrame:
    """Rows whose ``dense_rank()`` over ``col`` is <= n (ties all kept).

    ``among``: the rows that are ranked, where they are not those of ``df``."""
    nulls_first = desc if nulls_first is None else nulls_first
    top = (df if among is None else among).select(col).distinct().orderBy(sort_key(col, desc, nulls_first)).limit(n)
    return _threshold_filter(df, col, top, desc, nulls_first)


def rank_top_n(df: DataFrame, col: str, n: int, desc: bool = True,
               nulls_first: bool | None = None) -> DataFrame:
    """Rows whose ``rank()`` over ``col`` is <= n (ties may exceed n)."""
    nulls_first = desc if nulls_first is None else nulls_first
    top = df.select(col).orderBy(sort_key(col, desc, nulls_first)).limit(n)
    return _threshold_filter(df, col, top, desc, nulls_first)


def flag_rank_top_n(df: DataFrame, col: str, n: int, name: str, desc: bool = True,
                    nulls_first: bool | None = None) -> DataFrame:
    """W6 as a label: keeps every row, ``name`` is true where ``rank() <= n``."""
    nulls_first = desc if nulls_first is None else nulls_first
    top = df.select(col).orderBy(sort_key(col, desc, nulls_first)).limit(n)
    thr = _threshold(col, top, desc, nulls_first)
    # an empty df gives an empty threshold; a left join keeps every row
    flagged = df.join(thr, F.lit(True), "left")
    return (flagged.withColumn(name, F.coalesce(
        _at_least_as_good(F.col(col), F.col(_THR), desc, nulls_first), F.lit(False)))
        .drop(_THR))


def with_rank(df: DataFrame, col: str, n: int, name: str = "rank", desc: bool = True,
              nulls_first: bool | None = None) -> DataFrame:
    """Rows with ``rank() <= n`` plus their rank.

    The qualifying rows hold at most ``n`` distinct values, so the rank of each
    value (1 + rows strictly better) is computed on that tiny value table and
    broadcast back; tied rows never pass through a single task.
    """
    nulls_first = desc if nulls_first is None else nulls_first
    rows = rank_top_n(df, col, n, desc, nulls_first)
    vals = rows.groupBy(col).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy(sort_key(col, desc, nulls_first)).rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = vals.select(F.col(col).alias("__v"),
                        (F.coalesce(F.sum("__c").over(w), F.lit(0)) + 1).alias(name))
    return (rows.join(F.broadcast(ranks), F.col(col).eqNullSafe(F.col("__v")), "inner")
            .drop("__v"))


def ordered(df: DataFrame, *specs: Column) -> DataFrame:
    """Total order for serving (order inside stored tables is moot)."""
    return df.orderBy(*specs)


def sample_first(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """T4: the first ``n`` rows by a deterministic order (bounded top-k)."""
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, col: str, n: int = 10, count_name: str = "n") -> DataFrame:
    """The ``n`` most common values; ties broken by value.

    Partial aggregation collapses hot values before the shuffle; the final
    top-n is a bounded ``TakeOrderedAndProject``.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(col).asc()).limit(n)


def choices(df: DataFrame, col: str) -> DataFrame:
    """Distinct sorted values for a selector."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def yearly_catalogue(df: DataFrame, id_col: str, date_col: str, order: Sequence[Column],
                     n: int, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """First ``n`` ids per calendar year by ``order``, then distinct ids."""
    with_year = df.withColumn("__year", F.year(date_col))
    capped = top_n_per_key(with_year, ["__year"], order, tiebreak or [F.col(id_col).asc()], n)
    return capped.select(id_col).distinct()
