"""Synthetic snapshot history (H1-H5, M18) and the month spine.

Per (movie, month): a deterministic phase, noise and spike bucket from md5
of the ids (identical in any SQL engine with md5), then the popularity
curve, rating drift, vote decay and revenue jitter. The spine has a fixed
small size (``start - end`` months), so broadcasting it is safe.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.functions.columns import greatest_strict, least_strict, md5_bucket

# The synthetic history formulas.
# popularity = max(0, p * (0.70 + 0.45 * sin(2 pi (months_ago / 6 + phase)))
#                      * (0.90 + 0.20 * noise) * spike), spike = 1.6 + noise
#              when the spike bucket (of 100) is below 8, else 1; round 3
# rating     = clamp(0, 10, round(v + (noise - 0.5) * 0.15 - 0.02 * months_ago, 2))
# votes      = round(max(0, c * (1 - 0.004 * months_ago) * (0.998 + 0.004 * noise)))
# revenue    = round(r * (0.997 + 0.006 * noise))
# phase and noise are buckets of 1000 divided by 1000; the spike bucket salt is 7.
CURVE_BASE, CURVE_AMPLITUDE, CURVE_PERIOD = 0.70, 0.45, 6.0
NOISE_BASE, NOISE_SPAN = 0.90, 0.20
SPIKE_BUCKETS, SPIKE_CUT, SPIKE_BASE, SPIKE_SALT = 100, 8, 1.6, 7
RATING_NOISE, RATING_DRIFT, RATING_MIN, RATING_MAX = "0.15", "0.02", "0", "10"
VOTE_DECAY, VOTE_BASE, VOTE_SPAN = "0.004", "0.998", "0.004"
REVENUE_BASE, REVENUE_SPAN = "0.997", "0.006"
NOISE_BUCKETS = 1000


def month_spine_from(anchor: DataFrame, col: str, start_months: int = 6,
                     end_months: int = 1) -> DataFrame:
    """Month starts from ``-start_months`` up to, not including,
    ``-end_months`` relative to the month of the date in ``anchor[col]``
    (a one-row frame), with ``months_ago``. Size: ``start - end`` rows."""
    first = F.trunc(F.col(col), "MM")
    if start_months - end_months <= 0:
        return anchor.select(F.lit(None).cast("date").alias("snapshot_date"),
                             F.lit(None).cast("int").alias("months_ago")).limit(0)
    seq = F.sequence(F.add_months(first, -start_months), F.add_months(first, -end_months - 1),
                     F.expr("interval 1 month"))
    months = anchor.select(first.alias("__first"), F.explode(seq).alias("snapshot_date"))
    return months.select("snapshot_date",
                         F.months_between("__first", "snapshot_date").cast("int").alias("months_ago"))


def month_spine(spark, today: dt.date, start_months: int = 6, end_months: int = 1) -> DataFrame:
    """J4 for a fixed run date (``current_date`` of the run)."""
    anchor = spark.range(1).select(F.lit(today).alias("today"))
    return month_spine_from(anchor, "today", start_months, end_months)


def _round(x: Column, d: int) -> Column:
    return F.round(x, d)


def _d(text: str) -> Column:
    """Exact decimal literal."""
    return F.lit(Decimal(text))


def synthetic_history(movies: DataFrame, today: dt.date, start_months: int = 6,
                      end_months: int = 1) -> DataFrame:
    """``movies`` (movie_id, popularity, vote_average, vote_count,
    revenue = current values) x the month spine -> synthetic snapshot rows.

    Movies with unknown popularity are skipped.
    """
    return _history(movies, month_spine(movies.sparkSession, today, start_months, end_months))


def synthetic_history_from(movies: DataFrame, anchor: DataFrame, col: str,
                           start_months: int = 6, end_months: int = 1) -> DataFrame:
    """M18 with the run date taken from a one-row frame (data-derived)."""
    return _history(movies, month_spine_from(anchor, col, start_months, end_months))


def _history(movies: DataFrame, spine: DataFrame) -> DataFrame:
    spine = F.broadcast(spine)  # start - end rows
    base = (movies.filter(F.col("popularity").isNotNull())
            .select("movie_id", F.col("popularity").alias("cur_pop"),
                    F.col("vote_average").alias("cur_va"), F.col("vote_count").alias("cur_vc"),
                    F.col("revenue").alias("cur_rev"))
            .crossJoin(spine))
    phase = md5_bucket(NOISE_BUCKETS, F.col("movie_id")) / F.lit(float(NOISE_BUCKETS))
    noise_k = md5_bucket(NOISE_BUCKETS, F.col("movie_id"), F.col("months_ago"))
    spike_bucket = md5_bucket(SPIKE_BUCKETS, F.col("movie_id"), F.col("months_ago"),
                              F.lit(SPIKE_SALT))
    g = base.select("*", phase.alias("phase"), noise_k.alias("noise_k"),
                    spike_bucket.alias("spike_bucket"))
    # popularity is a float curve; rating, votes and revenue are computed in
    # exact decimals (the source numbers are decimals), then rounded half up
    noise = F.col("noise_k") / F.lit(float(NOISE_BUCKETS))
    ago = F.col("months_ago").cast("double")
    spike = (F.when(F.col("spike_bucket") < SPIKE_CUT, F.lit(SPIKE_BASE) + noise)
             .otherwise(F.lit(1.0)))
    wave = F.sin(F.lit(2.0) * F.pi() * (ago / F.lit(CURVE_PERIOD) + F.col("phase")))
    curve = (F.col("cur_pop")
             * (F.lit(CURVE_BASE) + F.lit(CURVE_AMPLITUDE) * wave)
             * (F.lit(NOISE_BASE) + F.lit(NOISE_SPAN) * noise)
             * spike)
    popularity = _round(greatest_strict(F.lit(0.0), curve), 3)
    nx = F.col("noise_k").cast("decimal(18,0)") * _d("0.001")
    agox = F.col("months_ago").cast("decimal(9,0)")
    drift = _round(F.col("cur_va").cast("decimal(4,2)") + (nx - _d("0.5")) * _d(RATING_NOISE)
                   - _d(RATING_DRIFT) * agox, 2)
    vote_average = least_strict(_d(RATING_MAX), greatest_strict(_d(RATING_MIN), drift)).cast(
        "decimal(4,2)")
    votes = greatest_strict(_d("0"), F.col("cur_vc").cast("decimal(20,0)")
                            * (_d("1") - _d(VOTE_DECAY) * agox)
                            * (_d(VOTE_BASE) + _d(VOTE_SPAN) * nx))
    vote_count = _round(votes, 0).cast("bigint")
    revenue = _round(F.col("cur_rev").cast("decimal(20,0)")
                     * (_d(REVENUE_BASE) + _d(REVENUE_SPAN) * nx), 0).cast("bigint")
    return g.select("movie_id", "snapshot_date", popularity.alias("popularity"),
                    vote_average.alias("vote_average"), vote_count.alias("vote_count"),
                    revenue.alias("revenue"))
