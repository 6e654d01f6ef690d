"""Tables laid out by range, and positions in a total order.

A served table is read by ranges of a few columns (a year, a tier, a title).
``clustered`` deals its rows into ranges of these columns and sorts each, so
that a Parquet file holds a narrow range: filters on the columns skip files and
row groups by their statistics. The tie columns are part of the ranges, so a
value that many rows share is split over files as well.

``with_position`` numbers the rows of such a stored table by the total order
without a window over all rows: a row's position is the number of rows in
earlier files plus its row number in its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def clustered(df: DataFrame, by: Sequence[str], tie: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` ranges of (``by``, ``tie``), ascending with NULL first.

    ``by`` and ``tie`` together should tell rows apart, so that no range grows
    with a common value. Store the result, e.g. with ``as_table``.
    """
    order = _order([*by, *tie])
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def with_position(stored: DataFrame, by: Sequence[str], tie: Sequence[str], name: str = "position") -> DataFrame:
    """Rows of a stored ``clustered`` table with their place, from 1, in its order.

    ``stored`` is read twice, once for the order's columns only. Each window
    holds one file's rows; the files, a row each, are numbered in one more.
    """
    keys = [*by, *tie]
    files = (stored.select(F.col("_metadata.file_path").alias("__file"), *keys).groupBy("__file")
             .agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*keys)).alias("__least"),
                  F.max(F.struct(*keys)).alias("__most")))
    # equal rows at a border: the file that ends there comes first
    earlier = Window.orderBy("__least", "__most").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("__file", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    rows = stored.select("*", F.col("_metadata.file_path").alias("__file")).join(F.broadcast(offsets), "__file", "inner")
    within = F.row_number().over(Window.partitionBy("__file").orderBy(*_order(keys)))
    return rows.withColumn(name, F.col("__before") + within).drop("__file", "__before")
