"""Composed marts M1-M18, each a pure function DataFrame(s) -> DataFrame.

Dependency order: raw -> staging (M1, M2) -> intermediate (M3-M6) ->
dimensions/bridges (M7-M10) -> facts (M11, M12) -> aggregate marts
(M13-M17). M18 synthesises snapshot history for the first snapshot build.

Raw tables have columns ``raw_payload`` (VARIANT or JSON string) and
``ingested_at`` (TIMESTAMP_NTZ).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.config import MartConfig
from reelmart.functions.columns import (bayes_rating, has_both, ieq, margin, mask_unless,
                                        profit, rounded_mean, safe_ratio, tier)
from reelmart.functions.payload import FieldSpec, as_variant, extract, get_field
from reelmart.operators.explode import explode_payload
from reelmart.operators.history import synthetic_history, synthetic_history_from
from reelmart.operators.incremental import new_rows, upsert
from reelmart.operators.joins import with_global_mean
from reelmart.operators.median import exact_medians
from reelmart.operators.windows import dense_top_n, latest_per_key, sort_key, top_n_per_key

DEFAULT = MartConfig()

# The staged fields of a movie-details payload.
DETAIL_FIELDS = [
    FieldSpec("movie_id", "$.id", "int"),
    FieldSpec("title", "$.title", "string"),
    FieldSpec("original_title", "$.original_title", "string"),
    FieldSpec("original_language", "$.original_language", "string"),
    FieldSpec("status", "$.status", "string"),
    FieldSpec("release_date", "$.release_date", "date"),
    FieldSpec("runtime_min", "$.runtime", "int"),
    FieldSpec("budget", "$.budget", "number", zero_is_null=True),
    FieldSpec("revenue", "$.revenue", "number", zero_is_null=True),
    FieldSpec("vote_average", "$.vote_average", "decimal(4,2)"),
    FieldSpec("vote_count", "$.vote_count", "int"),
    FieldSpec("popularity", "$.popularity", "float"),
    FieldSpec("overview", "$.overview", "string"),
    FieldSpec("video", "$.video", "boolean"),
    FieldSpec("adult", "$.adult", "boolean"),
    FieldSpec("imdb_id", "$.imdb_id", "string"),
    FieldSpec("movie_belongs_to_collection", "$.belongs_to_collection", "variant"),
    FieldSpec("genres", "$.genres", "variant"),
    FieldSpec("production_companies", "$.production_companies", "variant"),
]

# The staged fields of a credits payload and of its list elements.
CREDIT_FIELDS = [
    FieldSpec("movie_id", "$.id", "int"),
    FieldSpec("cast_list", "$.cast", "variant"),
    FieldSpec("crew_list", "$.crew", "variant"),
]

# Fixed values.
GENRE_FIELDS = [FieldSpec("genre_id", "$.id", "int"), FieldSpec("genre_name", "$.name", "string")]

# Fixed values.
COMPANY_FIELDS = [
    FieldSpec("company_id", "$.id", "int"),
    FieldSpec("company_name", "$.name", "string"),
    FieldSpec("origin_country", "$.origin_country", "string", blank_is_null=True),
]

# Fixed values.
CAST_FIELDS = [
    FieldSpec("person_id", "$.id", "int"),
    FieldSpec("person_name", "$.name", "string"),
    FieldSpec("character", "$.character", "string"),
    FieldSpec("cast_order", "$.order", "variant"),
    FieldSpec("adult", "$.adult", "boolean"),
    FieldSpec("gender", "$.gender", "int"),
    FieldSpec("known_for_department", "$.known_for_department", "string"),
    FieldSpec("popularity", "$.popularity", "float"),
    FieldSpec("credit_id", "$.credit_id", "string"),
    FieldSpec("department", "$.department", "string"),
    FieldSpec("job", "$.job", "string"),
]

# Fixed values.
CREW_FIELDS = [
    FieldSpec("person_id", "$.id", "int"),
    FieldSpec("person_name", "$.name", "string"),
    FieldSpec("job", "$.job", "string"),
    FieldSpec("department", "$.department", "string"),
    FieldSpec("known_for_department", "$.known_for_department", "string"),
    FieldSpec("popularity", "$.popularity", "float"),
    FieldSpec("gender", "$.gender", "int"),
]


def _payload_hash(raw: DataFrame) -> Column:
    """Tiebreak among loads stamped at the same time.

    Raw tables written by ``load_raw`` carry ``payload_hash`` (xxhash64 of
    the landed JSON text, computed once at load). Otherwise the payload is
    serialised and hashed here: VARIANT values cannot be ordered or hashed
    directly. Either way only 8 bytes travel through the dedup shuffle.
    """
    if "payload_hash" in raw.columns:
        return F.col("payload_hash")
    return F.xxhash64(F.to_json(as_variant(raw, "raw_payload")))


# --- staging ---------------------------------------------------------------

def stg_movie_details(raw: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M1: one row per movie (latest load), 19 typed fields + ingested_at."""
    typed = extract(raw.withColumn("__tb", _payload_hash(raw)),
                    "raw_payload", DETAIL_FIELDS, keep=["ingested_at", "__tb"], on_error=cfg.on_error)
    latest = latest_per_key(typed, ["movie_id"],
                            [sort_key("ingested_at", desc=True, nulls_first=cfg.desc_nulls_first)],
                            [F.col("__tb").asc()])
    cols = [s.name for s in DETAIL_FIELDS] + ["ingested_at"]
    return latest.select(*cols)


def stg_credits(raw: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M2: one row per movie (latest load): cast and crew kept as VARIANT."""
    typed = extract(raw.withColumn("__tb", _payload_hash(raw)),
                    "raw_payload", CREDIT_FIELDS, keep=["ingested_at", "__tb"], on_error=cfg.on_error)
    latest = latest_per_key(typed, ["movie_id"],
                            [sort_key("ingested_at", desc=True, nulls_first=cfg.desc_nulls_first)],
                            [F.col("__tb").asc()])
    return latest.select("movie_id", "cast_list", "crew_list", "ingested_at")


# --- intermediate ----------------------------------------------------------

def int_movie_genre(stg: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M3: movie x genre (inner flatten)."""
    return explode_payload(stg, "genres", "$", GENRE_FIELDS, keep=["movie_id"],
                           on_error=cfg.on_error)


def int_movie_company(stg: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M4: movie x company; an empty origin country becomes NULL."""
    return explode_payload(stg, "production_companies", "$", COMPANY_FIELDS, keep=["movie_id"],
                           on_error=cfg.on_error)


def int_movie_cast(credits: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M5: the top ``cast_top_n`` cast rows per movie.

    Ranked by popularity *rounded to an integer* (desc), then billing order
    (asc), then person and credit ids as a total tiebreak. A person listed
    twice uses two places; the bridge (M10) de-duplicates later.
    """
    members = explode_payload(credits, "cast_list", "$", CAST_FIELDS, keep=["movie_id"],
                              on_error=cfg.on_error)
    rounded_pop = F.col("popularity").cast("decimal(38,0)")
    order_num = get_field(F.col("cast_order"), "$", "decimal(38,0)", cfg.on_error)
    top = top_n_per_key(
        members, ["movie_id"],
        [sort_key(rounded_pop, desc=True, nulls_first=cfg.desc_nulls_first),
         sort_key(order_num, desc=False, nulls_first=False)],
        [F.col("person_id").asc_nulls_last(), F.col("credit_id").asc_nulls_last(),
         F.col("popularity").desc_nulls_last(), F.col("character").asc_nulls_last(),
         *[F.col(c).asc_nulls_last() for c in ("person_name", "adult", "gender", "known_for_department",
                                               "department", "job")]],
        cfg.cast_top_n)
    return top.select("movie_id", "person_id", "person_name", "character", "adult", "gender",
                      "known_for_department", "department", "popularity", "credit_id", "job")


def int_movie_director(credits: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M6: crew rows whose job is 'director' in any case (not capped)."""
    crew = explode_payload(credits, "crew_list", "$", CREW_FIELDS, keep=["movie_id"],
                           on_error=cfg.on_error)
    return crew.filter(ieq("job", "director"))


# --- dimensions and bridges --------------------------------------------------

def dim_genre(int_genre: DataFrame) -> DataFrame:
    """M7: distinct (genre_id, genre_name) tuples."""
    return int_genre.select("genre_id", "genre_name").distinct()


def dim_company(int_company: DataFrame) -> DataFrame:
    """M7: distinct (company_id, company_name, origin_country) tuples."""
    return int_company.select("company_id", "company_name", "origin_country").distinct()


PERSON_COLS = ["person_id", "person_name", "known_for_department", "popularity", "gender"]


def dim_person(int_cast: DataFrame, int_director: DataFrame,
               cfg: MartConfig = DEFAULT) -> DataFrame:
    """M8: one row per person, the most popular version (cast UNION directors)."""
    # repeats fall to the row number below; UNION ALL saves a shuffle
    people = int_cast.select(*PERSON_COLS).unionByName(int_director.select(*PERSON_COLS))
    return latest_per_key(
        people, ["person_id"],
        [sort_key("popularity", desc=True, nulls_first=cfg.desc_nulls_first)],
        [F.col("person_name").asc_nulls_last(), F.col("known_for_department").asc_nulls_last(),
         F.col("gender").asc_nulls_last()])


def bridge_movie_genre(int_genre: DataFrame) -> DataFrame:
    """M9: distinct (movie_id, genre_id)."""
    return int_genre.select("movie_id", "genre_id").distinct()


def bridge_movie_company(int_company: DataFrame) -> DataFrame:
    """M9: distinct (movie_id, company_id)."""
    return int_company.select("movie_id", "company_id").distinct()


def bridge_movie_director(int_director: DataFrame) -> DataFrame:
    """M9: distinct (movie_id, person_id, job) - job keeps its raw case."""
    return int_director.select("movie_id", "person_id", "job").distinct()


def bridge_movie_cast(int_cast: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """One row per (movie, person): the most popular credit."""
    best = latest_per_key(
        int_cast, ["movie_id", "person_id"],
        [sort_key("popularity", desc=True, nulls_first=cfg.desc_nulls_first)],
        [F.col("character").asc_nulls_last(), F.col("credit_id").asc_nulls_last(),
         F.col("person_name").asc_nulls_last()])
    return best.select("movie_id", "person_id", "person_name",
                       F.col("character").alias("popular_character"), "popularity")


# --- facts -------------------------------------------------------------------

# The columns of the movie fact.
FACT_COLUMNS = ["movie_id", "title", "original_title", "original_language", "status",
                "release_date", "runtime_min", "budget", "revenue", "vote_average",
                "has_financial_data", "profit_margin", "revenue_to_budget_ratio", "profit",
                "vote_count", "popularity", "overview", "video", "adult", "imdb_id",
                "ingested_at"]


def fact_rows(stg: DataFrame) -> DataFrame:
    """M11 row logic: financial flags and guarded ratios."""
    return stg.select(
        "movie_id", "title", "original_title", "original_language", "status", "release_date",
        "runtime_min", "budget", "revenue", "vote_average",
        has_both("budget", "revenue").alias("has_financial_data"),
        margin("revenue", "budget").alias("profit_margin"),
        safe_ratio("revenue", "budget").alias("revenue_to_budget_ratio"),
        profit("revenue", "budget").alias("profit"),
        "vote_count", "popularity", "overview", "video", "adult", "imdb_id", "ingested_at")


def fact_movie(stg: DataFrame, target: DataFrame | None = None,
               cfg: MartConfig = DEFAULT) -> DataFrame:
    """One row per movie; incremental when ``target`` is given.

    Incremental run: staging rows stamped strictly after the target's newest
    ``ingested_at`` (or the historic start date when the target is empty)
    are merged on ``movie_id``; everything else in the target stays.
    """
    rows = fact_rows(stg)
    if target is None:
        return rows
    fresh = new_rows(rows, "ingested_at", target, cfg.historic_start_date)
    # staging holds one row per movie, so the updates are unique
    return upsert(target.select(*FACT_COLUMNS), fresh, ["movie_id"], check_unique=False)


# The columns of the snapshot fact and the observed fields.
SNAPSHOT_COLUMNS = ["movie_id", "snapshot_date", "popularity", "vote_average", "vote_count",
                    "revenue", "is_synthetic"]

OBSERVED_FIELDS = [
    FieldSpec("movie_id", "$.id", "int"),
    FieldSpec("popularity", "$.popularity", "float"),
    FieldSpec("vote_average", "$.vote_average", "decimal(4,2)"),
    FieldSpec("vote_count", "$.vote_count", "int"),
    FieldSpec("revenue", "$.revenue", "number", zero_is_null=True),
]


def observed_snapshots(raw: DataFrame, cfg: MartConfig = DEFAULT) -> DataFrame:
    """M12 input: one candidate row per load, dated by its load day."""
    typed = extract(raw.withColumn("__tb", _payload_hash(raw)),
                    "raw_payload", OBSERVED_FIELDS, keep=["ingested_at", "__tb"],
                    on_error=cfg.on_error)
    return typed.select(
        "movie_id", F.to_date("ingested_at").alias("snapshot_date"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ordering_ts"),
        "popularity", "vote_average", "vote_count", "revenue",
        F.lit(False).alias("is_synthetic"), "__tb")


def fact_movie_snapshot(raw: DataFrame, target: DataFrame | None = None,
                        seed: DataFrame | None = None,
                        cfg: MartConfig = DEFAULT) -> DataFrame:
    """One row per (movie, day).

    First build (``target`` None): observed loads UNION ALL the synthetic
    seed (M18 or a CSV, ordered at midnight so an observed row of the same
    day wins); the last capture per (movie, day) is kept.
    Incremental build: only days strictly after the target's newest day are
    added (a second run on the same day changes nothing), merged on
    (movie_id, snapshot_date).
    """
    obs = observed_snapshots(raw, cfg)
    if target is None and seed is not None:
        syn = seed.select(
            "movie_id", F.col("snapshot_date").cast("date").alias("snapshot_date"),
            F.col("snapshot_date").cast("timestamp_ntz").alias("ordering_ts"),
            F.col("popularity").cast("double").alias("popularity"),
            F.col("vote_average").cast("decimal(4,2)").alias("vote_average"),
            F.col("vote_count").cast("bigint").alias("vote_count"),
            F.col("revenue").cast("bigint").alias("revenue"),
            F.lit(True).alias("is_synthetic"), F.lit(None).cast("bigint").alias("__tb"))
        obs = obs.unionByName(syn)
    if target is not None:
        obs = new_rows(obs, "snapshot_date", target, cfg.historic_start_date)
    last = latest_per_key(
        obs, ["movie_id", "snapshot_date"],
        [sort_key("ordering_ts", desc=True, nulls_first=cfg.desc_nulls_first)],
        [F.col("is_synthetic").asc(), F.col("__tb").asc_nulls_last()])
    out = last.select(*SNAPSHOT_COLUMNS)
    if target is None:
        return out
    return upsert(target.select(*SNAPSHOT_COLUMNS), out, ["movie_id", "snapshot_date"],
                  check_unique=False)


def _current_values(raw: DataFrame, cfg: MartConfig) -> DataFrame:
    cur = extract(raw.withColumn("__tb", _payload_hash(raw)),
                  "raw_payload", OBSERVED_FIELDS, keep=["ingested_at", "__tb"],
                  on_error=cfg.on_error)
    return latest_per_key(cur, ["movie_id"],
                          [sort_key("ingested_at", desc=True, nulls_first=cfg.desc_nulls_first)],
                          [F.col("__tb").asc()])


def snapshot_seed(raw: DataFrame, today: dt.date, cfg: MartConfig = DEFAULT) -> DataFrame:
    """Synthetic monthly history for the latest version of each movie."""
    return synthetic_history(_current_values(raw, cfg), today, cfg.history_start_months,
                             cfg.history_end_months)


def snapshot_seed_from(raw: DataFrame, anchor: DataFrame, col: str,
                       cfg: MartConfig = DEFAULT) -> DataFrame:
    """M18 with the run date read from a one-row frame."""
    return synthetic_history_from(_current_values(raw, cfg), anchor, col,
                                  cfg.history_start_months, cfg.history_end_months)


# --- aggregate marts ----------------------------------------------------------

def daily_movie_trends(fact: DataFrame, snapshot: DataFrame,
                       cfg: MartConfig = DEFAULT) -> DataFrame:
    """Snapshot rows of the movies in the top ``top_n_movies`` dense
    ranks of (fact) popularity, among movies with more than
    ``min_vote_count`` votes that have at least one snapshot.

    The dense rank is taken over distinct popularity values of the eligible
    movies (a bounded top-n), then the winning movies are joined to their
    snapshot rows; no rows funnel through a single window task.
    """
    eligible = fact.filter(F.col("vote_count") > cfg.min_vote_count).select(
        "movie_id", "title", "budget", F.col("popularity").alias("latest_popularity"))
    # only movies with a snapshot are ranked; the join below drops the others
    ranked = eligible.join(snapshot.select("movie_id"), "movie_id", "left_semi")
    top = dense_top_n(eligible, "latest_popularity", cfg.top_n_movies, desc=True,
                      nulls_first=cfg.desc_nulls_first, among=ranked)
    return top.join(snapshot, "movie_id", "inner").select(
        "movie_id", "snapshot_date", "title", "budget", "latest_popularity", "popularity",
        "vote_average", "vote_count", "revenue", "is_synthetic")


def agg_genre_roi(fact: DataFrame, bridge_genre: DataFrame, genres: DataFrame) -> DataFrame:
    """Genre x release year: counts, mean and exact median ROI/margin."""
    releases = fact.filter(F.col("release_date").isNotNull()).select(
        "movie_id", F.year("release_date").alias("release_year"),
        mask_unless("has_financial_data", F.col("revenue_to_budget_ratio")).alias("roi"),
        mask_unless("has_financial_data", F.col("profit_margin")).alias("pm"))
    rows = (bridge_genre.join(genres, "genre_id", "inner")
            .join(releases, "movie_id", "inner")
            .select("genre_name", "release_year", "roi", "pm")
            # counted in tasks of bounded size, apart from the joins, which all reads share
            .hint("rebalance"))
    keys = ["genre_name", "release_year"]
    base = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("movie_count"),
        F.count("roi").alias("movie_count_with_financial_data"),
        F.round(F.avg("roi"), 2).alias("average_revenue_to_budget_ratio"),
        F.round(F.avg("pm"), 2).alias("average_profit_margin"))
    meds = exact_medians(rows, keys, {"__mroi": "roi", "__mpm": "pm"})
    # matched null-safe, as a join that drops NULL keys puts a filter below the reads of the
    # medians: these then differ from the other reads and Spark runs the joins once for each
    meds = meds.withColumnsRenamed({k: f"__{k}" for k in keys})
    named = F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()
    median = lambda name: F.when(named, F.round(name, 2))
    return (base.join(meds, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left")
            .select(*keys, "movie_count", "movie_count_with_financial_data",
                    "average_revenue_to_budget_ratio", "average_profit_margin",
                    median("__mroi").alias("median_revenue_to_budget_ratio"),
                    median("__mpm").alias("median_profit_margin")))


def agg_budget_outcomes(fact: DataFrame, bounds=None, labels=None) -> DataFrame:
    """Budget tier: count, total/mean revenue, mean profit and rating.

    Only movies with both budget and revenue known enter (also for the
    rating mean).
    """
    kw = {}
    if bounds is not None:
        kw["bounds"] = bounds
    if labels is not None:
        kw["labels"] = labels
    money = fact.filter(F.col("has_financial_data") == F.lit(True))
    return (money.withColumn("budget_tier", tier("budget", **kw))
            .groupBy("budget_tier").agg(
                F.count(F.lit(1)).alias("movie_count"),
                F.sum(F.coalesce(F.col("revenue"), F.lit(0))).alias("total_revenue"),
                F.round(F.avg("revenue"), 2).alias("average_revenue"),
                F.round(F.avg("profit"), 2).alias("average_profit"),
                rounded_mean("vote_average", 2).alias("average_rating")))


def agg_talented_cast_member(fact: DataFrame, bridge_cast: DataFrame,
                             bridge_director: DataFrame, persons: DataFrame,
                             cfg: MartConfig = DEFAULT) -> DataFrame:
    """Person x role with at least ``min_films`` joined rows.

    The prior mean is the plain mean rating over movies with more than
    ``min_vote_count`` votes; every movie gets a Bayesian weighted rating.
    """
    movies = fact.select("movie_id", "revenue", "vote_average", "vote_count")
    rated = with_global_mean(movies, "vote_average",
                             F.col("vote_count") > cfg.min_vote_count, "__gmean")
    weighted = rated.select(
        "movie_id", "revenue",
        bayes_rating("vote_average", "vote_count", "__gmean", cfg.min_vote_count)
        .alias("weighted_rating_score"))
    roles = (bridge_cast.select("person_id", "movie_id", F.lit("actor").alias("role_type"))
             .unionByName(bridge_director.select("person_id", "movie_id",
                                                 F.lit("director").alias("role_type"))))
    # aggregate first (partial sums spread a busy person), then fetch the names
    # of the few who stay: the person dimension has one row per person
    busy = (roles.join(weighted, "movie_id", "inner").groupBy("person_id", "role_type").agg(
        F.count(F.lit(1)).alias("movie_count"),
        F.round(F.avg("weighted_rating_score"), 2).alias("average_vote_rating"),
        F.round(F.avg("revenue"), 2).alias("average_revenue"))
        .filter(F.col("movie_count") >= cfg.min_films))
    return busy.join(persons.select("person_id", "person_name"), "person_id", "inner").select(
        "person_id", "person_name", "role_type", "movie_count", "average_vote_rating", "average_revenue")


def agg_genre_evolution(fact: DataFrame, bridge_genre: DataFrame, genres: DataFrame) -> DataFrame:
    """Genre x release year x month: mean popularity (2 dp)."""
    movies = fact.filter(F.col("release_date").isNotNull()).select(
        "movie_id", F.year("release_date").alias("release_year"),
        F.month("release_date").alias("release_month"), "popularity")
    return (bridge_genre.join(genres, "genre_id", "inner").join(movies, "movie_id", "inner")
            .groupBy("genre_name", "release_year", "release_month")
            .agg(F.round(F.avg("popularity"), 2).alias("average_popularity")))
