"""Serving queries V1-V6 over the aggregate marts.

They return DataFrames (the caller renders them); user choices are
parameters pushed into the plan as ``isin`` filters, and column names are
lower-cased the way the dashboard reads them (S9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.operators.setops import reaggregate_mean
from reelmart.operators.windows import flag_rank_top_n, ordered

# The dashboard's default selections.
DEFAULT_GENRES = ("Action", "Comedy", "Drama", "Horror")
DEFAULT_ROLES = ("actor", "director")
LABELS = 8


def serve(df: DataFrame) -> DataFrame:
    """Column names lower-cased, rows stay distributed."""
    return df.toDF(*[c.lower() for c in df.columns])


def isin_filter(df: DataFrame, col: str, values: Sequence | None) -> DataFrame:
    """Keep rows whose ``col`` is one of ``values`` (None = no filter)."""
    return df if values is None else df.filter(F.col(col).isin(list(values)))


def trending(trends: DataFrame) -> DataFrame:
    """V1: title, date, popularity, synthetic flag; newest first."""
    return serve(ordered(trends.select("title", "snapshot_date", "popularity", "is_synthetic"),
                         F.col("snapshot_date").desc_nulls_last()))


def genre_roi(roi: DataFrame, genres: Sequence[str] | None = DEFAULT_GENRES) -> DataFrame:
    """V2: mean ROI per genre and year for the chosen genres."""
    out = roi.filter(F.col("average_revenue_to_budget_ratio").isNotNull()).select(
        "genre_name", "release_year",
        F.col("average_revenue_to_budget_ratio").alias("avg_roi"), "movie_count")
    return serve(isin_filter(out, "genre_name", genres))


def genre_margin(roi: DataFrame, genres: Sequence[str] | None = DEFAULT_GENRES) -> DataFrame:
    """V3: mean profit margin per genre and year for the chosen genres."""
    out = roi.filter(F.col("average_profit_margin").isNotNull()).select(
        "genre_name", "release_year",
        F.col("average_profit_margin").alias("avg_profit_margin"), "movie_count")
    return serve(isin_filter(out, "genre_name", genres))


def talent(t: DataFrame, roles: Sequence[str] | None = DEFAULT_ROLES,
           labels: int = LABELS) -> DataFrame:
    """V4: people with known positive revenue, chosen roles, and a label flag
    on the ``labels`` best ratings (``rank() <= labels``, ties included)."""
    rows = isin_filter(t.filter(F.col("average_revenue") > 0), "role_type", roles).select(
        "person_name", "role_type", "movie_count", "average_vote_rating", "average_revenue")
    return serve(flag_rank_top_n(rows, "average_vote_rating", labels, "is_label"))


def budget_tiers(outcomes: DataFrame) -> DataFrame:
    """V5: budget tiers in label order."""
    return serve(ordered(outcomes.select("budget_tier", "average_revenue", "average_rating", "movie_count"),
                         F.col("budget_tier").asc_nulls_first()))


def genre_by_year(evolution: DataFrame) -> DataFrame:
    """V6: unweighted mean of the monthly means per genre and year (A10)."""
    return serve(reaggregate_mean(evolution, ["genre_name", "release_year"],
                                  "average_popularity", "avg_pop"))
