"""Incremental operators (I1-I5) for batch runs.

``new_rows`` is the watermark filter, ``upsert`` the merge on key. Both are
pure DataFrame functions: the caller decides where the result is written
(``sources.tables`` never lets a plan overwrite the path it reads).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def watermark(target: DataFrame, col: str, default) -> DataFrame:
    """One row ``coalesce(max(col), default)`` cast to ``col``'s type."""
    dtype = target.schema[col].dataType
    return target.agg(F.coalesce(F.max(col), F.lit(default).cast(dtype)).alias("__wm"))


def watermark_value(target: DataFrame, col: str, default):
    """The watermark as a Python literal (one-row result).

    Filtering on a literal lets Spark prune partitions of a raw table that
    is partitioned by load date.
    """
    return watermark(target, col, default).first()["__wm"]


def new_rows(df: DataFrame, col: str, target: DataFrame | None,
             default: dt.date | dt.datetime | None = None, literal: bool = False) -> DataFrame:
    """Rows of ``df`` strictly newer than the target's watermark.

    ``target`` None means a first build: every row. An empty target uses
    ``default``. A row stamped exactly at the old maximum, or late with an
    older stamp, is not picked up.
    """
    if target is None:
        return df
    if literal:
        wm = watermark_value(target, col, default)
        return df.filter(F.col(col) > F.lit(wm)) if wm is not None else df.limit(0)
    wm = F.broadcast(watermark(target, col, default))  # exactly one row
    return df.crossJoin(wm).filter(F.col(col) > F.col("__wm")).drop("__wm")


def assert_unique(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates`` unchanged, but evaluation raises on a duplicate key.

    The check is part of the plan: a row's predecessor within its key (one row
    of look-back, nothing is gathered) calls ``raise_error``. It costs no
    separate job, reads ``updates`` once and fires whenever the result is
    computed.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*keys)
    msg = F.concat(F.lit(f"upsert: duplicate key in updates on {keys}: "),
                   F.to_json(F.struct(*keys)))
    # the filter needs the row number, so it cannot be pushed below the window
    # and fire on clean rows
    clean = F.when(F.row_number().over(w) == 1, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean"))
    return updates.withColumn("__clean", clean).filter("__clean").drop("__clean")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           check_unique: bool = True) -> DataFrame:
    """Merge on key - matching target rows are replaced, others inserted.

    Grain: one row per key (given a unique target). The anti-join shuffles
    both sides on the keys; both sides are unique per key, so no key is hot.
    """
    keys = list(keys)
    updates = updates.select(*target.columns)
    if check_unique:
        updates = assert_unique(updates, keys)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates)
