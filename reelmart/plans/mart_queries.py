"""Registered queries that run the whole mart pipeline.

Spark side: movie-style payloads are derived from the supplied tables
(``derive``), parsed, staged, exploded, ranked, merged and aggregated by the
library. Oracle side: DuckDB SQL that computes the same tables straight from
the base tables (no JSON), so each entry checks the pipeline end to end.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelmart.config import MartConfig
from reelmart.functions.payload import FieldSpec, array_size, extract
from reelmart.operators import profile
from reelmart.operators.windows import top_values
from reelmart.plans import derive, marts, serve
from reelmart.plans.data_tests import DECLARED, run_declared
from reelmart.session import checkpoint_dir
from reelmart.sources import (append_raw, append_snapshot_days, as_table, as_view, land_payloads, load_new, load_raw,
                              merge_fact, raw, read_seed, snapshot_table, write_seed)
from reelmart.sources.costored import CoStored
from reelmart.sources.tables import write_once
from reelmart.plans.queries import ORACLE, TS, _history_sql, _iround_avg, _md5_sql, _sround, register


class World:
    """The marts over the derived payloads, lazy frames built on first use.

    ``store`` names the models that several plans of one query read: those are
    written once as Parquet in the shared folder, or ``(model, columns)`` where
    all of these plans read no other columns. ``shredded``: whether payloads are
    stored field by field. The seed is dated by the last load, read from the
    data as a one-row frame.
    """

    def __init__(self, spark, d: str, store: tuple = (), cfg: MartConfig = marts.DEFAULT, shredded: bool = True):
        self.spark, self.d, self.cfg, self.shredded = spark, d, cfg, shredded
        self.store = dict((m, None) if isinstance(m, str) else m for m in store)
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            df = MODELS[name](self)
            if name in self.store:
                df = write_once(df.select(*(self.store[name] or df.columns)), name,
                                derive.order_parts(self.spark, self.d), self.shredded)
            self.built[name] = df
        return self.built[name]


def _lists(w: World) -> DataFrame | None:
    """The cells of an order as one row, where several plans read them."""
    return w["cell_lists"] if "cell_lists" in w.store else None


def _seed(w: World) -> DataFrame:
    raw = w["raw_movie_details"]
    anchor = raw.agg(F.to_date(F.max("ingested_at")).alias("today"))
    return marts.snapshot_seed_from(raw, anchor, "today", w.cfg)


MODELS = {
    "cells": lambda w: derive.order_cells(w.spark, w.d),
    "cell_lists": lambda w: derive.cell_lists(w["cells"]),
    "raw_movie_details": lambda w: derive.raw_movie_details(w.spark, w.d, w["cells"], _lists(w)),
    "raw_credits": lambda w: derive.raw_credits(w.spark, w.d, w["cells"], _lists(w)),
    "stg_movie_details": lambda w: marts.stg_movie_details(w["raw_movie_details"], w.cfg),
    "stg_credits": lambda w: marts.stg_credits(w["raw_credits"], w.cfg),
    "int_movie_genre": lambda w: marts.int_movie_genre(w["stg_movie_details"], w.cfg),
    "int_movie_company": lambda w: marts.int_movie_company(w["stg_movie_details"], w.cfg),
    "int_movie_cast": lambda w: marts.int_movie_cast(w["stg_credits"], w.cfg),
    "int_movie_director": lambda w: marts.int_movie_director(w["stg_credits"], w.cfg),
    "dim_genre": lambda w: marts.dim_genre(w["int_movie_genre"]),
    "dim_company": lambda w: marts.dim_company(w["int_movie_company"]),
    "dim_person": lambda w: marts.dim_person(w["int_movie_cast"], w["int_movie_director"], w.cfg),
    "bridge_movie_genre": lambda w: marts.bridge_movie_genre(w["int_movie_genre"]),
    "bridge_movie_company": lambda w: marts.bridge_movie_company(w["int_movie_company"]),
    "bridge_movie_cast": lambda w: marts.bridge_movie_cast(w["int_movie_cast"], w.cfg),
    "bridge_movie_director": lambda w: marts.bridge_movie_director(w["int_movie_director"]),
    "fact_movie": lambda w: marts.fact_movie(w["stg_movie_details"], None, w.cfg),
    "snapshot_seed": _seed,
    "fact_movie_snapshot": lambda w: marts.fact_movie_snapshot(w["raw_movie_details"], None, w["snapshot_seed"], w.cfg),
    "daily_movie_trends": lambda w: marts.daily_movie_trends(w["fact_movie"], w["fact_movie_snapshot"], w.cfg),
    "agg_genre_roi": lambda w: marts.agg_genre_roi(w["fact_movie"], w["bridge_movie_genre"], w["dim_genre"]),
    "agg_budget_outcomes": lambda w: marts.agg_budget_outcomes(w["fact_movie"]),
    "agg_talented_cast_member": lambda w: marts.agg_talented_cast_member(
        w["fact_movie"], w["bridge_movie_cast"], w["bridge_movie_director"], w["dim_person"], w.cfg),
    "agg_genre_evolution": lambda w: marts.agg_genre_evolution(
        w["fact_movie"], w["bridge_movie_genre"], w["dim_genre"]),
}

#: What each mart's plans read more than once.
GENRE = (("stg_movie_details", tuple(f.name for f in marts.DETAIL_FIELDS if f.name not in (
    "production_companies", "movie_belongs_to_collection")) + ("ingested_at",)),)
SNAPSHOT = ("raw_movie_details",)
TREND_FACT = ("movie_id", "title", "budget", "popularity", "vote_count")
TRENDS = ("raw_movie_details", ("fact_movie", TREND_FACT), "fact_movie_snapshot")
TALENT = ("cell_lists", ("fact_movie", ("movie_id", "revenue", "vote_average", "vote_count")), "stg_credits",
          ("int_movie_cast", ("movie_id", *marts.PERSON_COLS, "character", "credit_id")))
#: All but those that one other model reads once, as part of its own plan.
EVERY = tuple(m for m in MODELS if m not in ("cells", "raw_credits", "snapshot_seed"))


def world(spark, d, *store, shredded: bool = True) -> World:
    return World(spark, d, store, shredded=shredded)


_W = f"""
WITH lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
         l.l_extendedprice, l.l_discount, s.s_name, s.s_nationkey, n.n_name, p.p_brand,
         CAST(split_part(p.p_brand, '#', 2) AS BIGINT) AS brand_no
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey),
cells AS (
  SELECT l_orderkey AS movie_id, p_brand, brand_no, s_nationkey, n_name, COUNT(*) AS n,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS cents, SUM(l_quantity) AS quantity,
         MAX(l_quantity) AS most, MAX(l_discount) AS disc, CAST(MIN(l_linenumber) AS BIGINT) AS first_line
  FROM lines GROUP BY ALL),
agg AS (
  SELECT movie_id, CAST(SUM(n) AS BIGINT) AS runtime, CAST(SUM(cents) AS BIGINT) AS budget0,
         CAST(SUM(quantity) AS BIGINT) AS votes0, MAX(disc) AS maxdisc
  FROM cells GROUP BY 1),
mv AS (
  SELECT o.o_orderkey AS movie_id, o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice,
         o.o_orderdate, o.o_orderpriority, COALESCE(a.runtime, 0) AS runtime,
         COALESCE(a.budget0, 0) AS budget0, COALESCE(a.votes0, 0) AS votes0,
         ROUND(a.maxdisc * 100.0, 2) AS va
  FROM orders o LEFT JOIN agg a ON o.o_orderkey = a.movie_id),
loads AS (
  SELECT mv.*, h.hours, h.factor, h.extra, mv.o_orderdate + to_hours(h.hours) AS ingested_at
  FROM mv JOIN (VALUES (1, CAST(1.0 AS DOUBLE), 0, false), (7, CAST(1.5 AS DOUBLE), 10, true),
                       (25, CAST(2.0 AS DOUBLE), 20, true)) h(hours, factor, extra, open_only)
    ON (NOT h.open_only) OR mv.o_orderstatus = 'O'),
det AS (
  SELECT movie_id, o_orderkey, o_custkey, o_orderstatus, o_orderpriority, ingested_at,
         CAST(o_orderdate AS DATE) AS release_date, runtime,
         NULLIF(budget0, 0) AS budget,
         NULLIF(CAST(ROUND(o_totalprice * 100) AS BIGINT), 0) AS revenue,
         CAST(va AS DECIMAL(4,2)) AS vote_average, votes0 + extra AS vote_count,
         o_totalprice / CAST(1000 AS DOUBLE) * factor AS popularity
  FROM loads),
stg AS (SELECT * FROM (SELECT det.*, row_number() OVER (PARTITION BY movie_id
                                                        ORDER BY ingested_at DESC) AS rn
                       FROM det) WHERE rn = 1),
fact AS (
  SELECT movie_id, 'Title ' || CAST(movie_id AS VARCHAR) AS title,
         'Original ' || CAST(movie_id AS VARCHAR) AS original_title,
         lower(o_orderstatus) AS original_language,
         CASE o_orderstatus WHEN 'F' THEN 'Released' WHEN 'O' THEN 'Post Production'
              ELSE 'In Production' END AS status,
         release_date, CAST(runtime AS BIGINT) AS runtime_min, budget, revenue, vote_average,
         (budget IS NOT NULL AND revenue IS NOT NULL) AS has_financial_data,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL
              THEN CAST(revenue - budget AS DOUBLE) / NULLIF(CAST(budget AS DOUBLE), 0) END
              AS profit_margin,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL
              THEN CAST(revenue AS DOUBLE) / NULLIF(CAST(budget AS DOUBLE), 0) END
              AS revenue_to_budget_ratio,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL THEN revenue - budget END AS profit,
         vote_count, popularity, 'Ordered with priority ' || o_orderpriority AS overview,
         false AS video, o_orderpriority = '1-URGENT' AS adult,
         'tt' || CAST(o_orderkey AS VARCHAR) AS imdb_id, ingested_at
  FROM stg),
cred_cast AS (
  SELECT x.movie_id, x.brand_no * 1000 + x.s_nationkey AS person_id, x.p_brand || ' of ' || x.n_name AS person_name,
         'Line ' || CAST(x.first_line AS VARCHAR) AS character, false AS adult,
         CAST(x.s_nationkey % 3 AS BIGINT) AS gender, 'Acting' AS known_for_department,
         'Acting' AS department, x.most / CAST(10 AS DOUBLE) AS popularity,
         CAST(x.movie_id AS VARCHAR) || '-' || CAST(x.brand_no * 1000 + x.s_nationkey AS VARCHAR) AS credit_id,
         'Actor' AS job, x.first_line AS cast_order
  FROM cells x JOIN orders o ON x.movie_id = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
int_cast AS (
  SELECT movie_id, person_id, person_name, character, adult, gender, known_for_department,
         department, popularity, credit_id, job FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id
        ORDER BY CAST(popularity AS DECIMAL(38,0)) DESC NULLS FIRST, cast_order ASC NULLS LAST,
                 person_id ASC NULLS LAST, credit_id ASC NULLS LAST, popularity DESC NULLS LAST,
                 character ASC NULLS LAST) AS rn
    FROM cred_cast) WHERE rn <= 10),
crew AS (
  SELECT cm.movie_id, c.c_custkey AS person_id, c.c_name AS person_name,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Director' WHEN 'MACHINERY' THEN 'DIRECTOR'
              WHEN 'AUTOMOBILE' THEN 'director' WHEN 'FURNITURE' THEN 'Producer'
              ELSE 'Writer' END AS job,
         'Directing' AS department, 'Directing' AS known_for_department,
         c.c_acctbal / CAST(1000 AS DOUBLE) AS popularity, CAST(c.c_nationkey % 3 AS BIGINT) AS gender
  FROM (SELECT DISTINCT movie_id FROM cells) cm
  JOIN orders o ON cm.movie_id = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
int_dir AS (SELECT * FROM crew WHERE lower(job) = 'director'),
int_genre AS (SELECT DISTINCT movie_id, CAST(s_nationkey AS BIGINT) AS genre_id, n_name AS genre_name FROM cells),
int_company AS (SELECT DISTINCT movie_id, brand_no AS company_id, p_brand AS company_name,
                       NULLIF(CASE WHEN brand_no < 5 THEN '' ELSE 'US' END, '') AS origin_country
                FROM cells),
dim_genre AS (SELECT DISTINCT genre_id, genre_name FROM int_genre),
bridge_genre AS (SELECT DISTINCT movie_id, genre_id FROM int_genre),
people AS (SELECT person_id, person_name, known_for_department, popularity, gender FROM int_cast
           UNION SELECT person_id, person_name, known_for_department, popularity, gender FROM int_dir),
dim_person AS (SELECT person_id, person_name, known_for_department, popularity, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY popularity DESC NULLS FIRST,
        person_name ASC NULLS LAST, known_for_department ASC NULLS LAST, gender ASC NULLS LAST) rn
    FROM people) WHERE rn = 1),
bridge_cast AS (SELECT movie_id, person_id, person_name, character AS popular_character, popularity FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id, person_id ORDER BY popularity DESC NULLS FIRST,
        character ASC NULLS LAST, credit_id ASC NULLS LAST) rn FROM int_cast) WHERE rn = 1),
bridge_dir AS (SELECT DISTINCT movie_id, person_id, job FROM int_dir),
anchor AS (SELECT date_trunc('month', CAST(MAX(ingested_at) AS DATE)) AS m0 FROM det),
spine AS (SELECT CAST(m0 - INTERVAL (k) MONTH AS DATE) AS snapshot_date, k AS months_ago
          FROM anchor, range(2, 7) t(k)),
hist AS (
  SELECT s.movie_id, p.snapshot_date, p.months_ago, s.popularity AS cur_pop,
         s.vote_average AS cur_va, s.vote_count AS cur_vc, s.revenue AS cur_rev,
         {_md5_sql('CAST(s.movie_id AS VARCHAR)', 1000)} / 1000.0 AS phase,
         {_md5_sql("CAST(s.movie_id AS VARCHAR) || '|' || CAST(p.months_ago AS VARCHAR)", 1000)} AS noise_k,
         {_md5_sql("CAST(s.movie_id AS VARCHAR) || '|' || CAST(p.months_ago AS VARCHAR) || '|7'", 100)} AS spike_bucket
  FROM stg s CROSS JOIN spine p WHERE s.popularity IS NOT NULL),
seed AS ({_history_sql('hist')}),
combined AS (
  SELECT movie_id, CAST(ingested_at AS DATE) AS snapshot_date, ingested_at AS ordering_ts,
         popularity, vote_average, vote_count, revenue, false AS is_synthetic FROM det
  UNION ALL
  SELECT movie_id, snapshot_date, CAST(snapshot_date AS TIMESTAMP), popularity, vote_average,
         vote_count, revenue, true FROM seed),
snapshot AS (
  SELECT movie_id, snapshot_date, popularity, vote_average, vote_count, revenue, is_synthetic FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id, snapshot_date
                                 ORDER BY ordering_ts DESC NULLS FIRST, is_synthetic ASC) rn
    FROM combined) WHERE rn = 1),
gm AS (SELECT CAST(SUM(CAST(vote_average * 100 AS BIGINT)) AS DOUBLE)
              / CAST(100 * COUNT(vote_average) AS DOUBLE) AS g FROM fact WHERE vote_count > 50),
weighted AS (
  SELECT f.movie_id, f.revenue,
         (CAST(f.vote_average AS DOUBLE) * CAST(f.vote_count AS DOUBLE) + gm.g * 50.0)
           / (CAST(f.vote_count AS DOUBLE) + 50.0) AS wr
  FROM fact f CROSS JOIN gm),
talent AS (
  SELECT r.person_id, dp.person_name, r.role_type, COUNT(*) AS movie_count,
         {_sround('AVG(w.wr)', 2)} AS average_vote_rating,
         {_iround_avg('w.revenue')} AS average_revenue
  FROM (SELECT person_id, movie_id, 'actor' AS role_type FROM bridge_cast
        UNION ALL SELECT person_id, movie_id, 'director' FROM bridge_dir) r
  JOIN dim_person dp ON dp.person_id = r.person_id JOIN weighted w ON w.movie_id = r.movie_id
  GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5),
roi_rows AS (
  SELECT d.genre_name, year(f.release_date) AS release_year,
         CASE WHEN f.has_financial_data THEN f.revenue_to_budget_ratio END AS roi,
         CASE WHEN f.has_financial_data THEN f.profit_margin END AS pm
  FROM bridge_genre b JOIN dim_genre d ON b.genre_id = d.genre_id
  JOIN fact f ON b.movie_id = f.movie_id WHERE f.release_date IS NOT NULL),
roi AS (
  SELECT genre_name, CAST(release_year AS BIGINT) AS release_year, COUNT(*) AS movie_count,
         COUNT(roi) AS movie_count_with_financial_data,
         {_sround('AVG(roi)', 2)} AS average_revenue_to_budget_ratio,
         {_sround('AVG(pm)', 2)} AS average_profit_margin,
         {_sround('median(roi)', 2)} AS median_revenue_to_budget_ratio,
         {_sround('median(pm)', 2)} AS median_profit_margin
  FROM roi_rows GROUP BY 1, 2),
evolution AS (
  SELECT d.genre_name, CAST(year(f.release_date) AS BIGINT) AS release_year,
         CAST(month(f.release_date) AS BIGINT) AS release_month,
         {_sround('AVG(f.popularity)', 2)} AS average_popularity
  FROM bridge_genre b JOIN dim_genre d ON b.genre_id = d.genre_id
  JOIN fact f ON b.movie_id = f.movie_id WHERE f.release_date IS NOT NULL GROUP BY 1, 2, 3),
va100 AS (SELECT *, CAST(ROUND(CAST(vote_average AS DOUBLE) * 100) AS BIGINT) AS va_x100 FROM fact),
outcomes AS (
  SELECT CASE WHEN budget < 25000000 THEN '1: <$25M' WHEN budget < 50000000 THEN '2: $25M-$50M'
              WHEN budget < 100000000 THEN '3: $50M-$100M' ELSE '4: >$100M' END AS budget_tier,
         COUNT(*) AS movie_count, CAST(SUM(COALESCE(revenue, 0)) AS BIGINT) AS total_revenue,
         {_iround_avg('revenue')} AS average_revenue, {_iround_avg('profit')} AS average_profit,
         CAST((2 * SUM(va_x100) + COUNT(va_x100)) // NULLIF(2 * COUNT(va_x100), 0) AS DOUBLE) / 100.0
           AS average_rating
  FROM va100 WHERE has_financial_data = true GROUP BY 1),
trends AS (
  SELECT movie_id, snapshot_date, title, budget, latest_popularity, popularity, vote_average,
         vote_count, revenue, is_synthetic FROM (
    SELECT m.movie_id, d.snapshot_date, m.title, m.budget, m.popularity AS latest_popularity,
           d.popularity, d.vote_average, d.vote_count, d.revenue, d.is_synthetic,
           dense_rank() OVER (ORDER BY m.popularity DESC NULLS FIRST) AS r
    FROM fact m JOIN snapshot d ON m.movie_id = d.movie_id WHERE m.vote_count > 50)
  WHERE r <= 10)
"""


def _reg(name: str, sql_tail: str):
    return register(name, _W + sql_tail)


@_reg("mart_fact_movie", f"""
SELECT movie_id, title, original_title, original_language, status,
       strftime(release_date, '%Y-%m-%d') AS release_date, runtime_min, budget, revenue,
       CAST(vote_average AS DOUBLE) AS vote_average, has_financial_data, profit_margin,
       revenue_to_budget_ratio, profit, vote_count, popularity, overview, video, adult, imdb_id,
       strftime(ingested_at, {TS}) AS ingested_at
FROM fact
""")
def q_fact_movie(spark, d):
    return world(spark, d)["fact_movie"]


@_reg("mart_int_movie_cast", """
SELECT * FROM int_cast
""")
def q_int_movie_cast(spark, d):
    return world(spark, d)["int_movie_cast"]


@_reg("mart_int_movie_director", "SELECT * FROM int_dir")
def q_int_movie_director(spark, d):
    return world(spark, d)["int_movie_director"]


@_reg("mart_int_movie_company", "SELECT * FROM int_company")
def q_int_movie_company(spark, d):
    return world(spark, d)["int_movie_company"]


@_reg("mart_dim_genre", "SELECT * FROM dim_genre")
def q_dim_genre(spark, d):
    return world(spark, d)["dim_genre"]


@_reg("mart_dim_company", "SELECT DISTINCT company_id, company_name, origin_country FROM int_company")
def q_dim_company(spark, d):
    return world(spark, d)["dim_company"]


@_reg("mart_dim_person", "SELECT * FROM dim_person")
def q_dim_person(spark, d):
    return world(spark, d)["dim_person"]


@_reg("mart_bridge_movie_genre", "SELECT * FROM bridge_genre")
def q_bridge_movie_genre(spark, d):
    return world(spark, d)["bridge_movie_genre"]


@_reg("mart_bridge_movie_company", "SELECT DISTINCT movie_id, company_id FROM int_company")
def q_bridge_movie_company(spark, d):
    return world(spark, d)["bridge_movie_company"]


@_reg("mart_bridge_movie_cast", "SELECT * FROM bridge_cast")
def q_bridge_movie_cast(spark, d):
    return world(spark, d)["bridge_movie_cast"]


@_reg("mart_bridge_movie_director", "SELECT * FROM bridge_dir")
def q_bridge_movie_director(spark, d):
    return world(spark, d)["bridge_movie_director"]


@_reg("mart_snapshot_seed", """
SELECT movie_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, popularity,
       CAST(vote_average AS DOUBLE) AS vote_average, vote_count, revenue FROM seed
""")
def q_snapshot_seed(spark, d):
    return world(spark, d, *SNAPSHOT)["snapshot_seed"]


@_reg("mart_fact_movie_snapshot", """
SELECT movie_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, popularity,
       CAST(vote_average AS DOUBLE) AS vote_average, vote_count, revenue, is_synthetic
FROM snapshot
""")
def q_fact_movie_snapshot(spark, d):
    return world(spark, d, *SNAPSHOT)["fact_movie_snapshot"]


@_reg("mart_daily_movie_trends", """
SELECT movie_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, title, budget,
       latest_popularity, popularity, CAST(vote_average AS DOUBLE) AS vote_average, vote_count,
       revenue, is_synthetic FROM trends
""")
def q_daily_movie_trends(spark, d):
    return world(spark, d, *TRENDS)["daily_movie_trends"]


@_reg("mart_agg_genre_roi", "SELECT * FROM roi")
def q_agg_genre_roi(spark, d):
    out = world(spark, d, *GENRE)["agg_genre_roi"]
    return out.withColumn("release_year", F.col("release_year").cast("bigint"))


@_reg("mart_agg_budget_outcomes", "SELECT * FROM outcomes")
def q_agg_budget_outcomes(spark, d):
    return world(spark, d)["agg_budget_outcomes"]


@_reg("mart_agg_talented_cast_member", "SELECT * FROM talent")
def q_agg_talented_cast_member(spark, d):
    return world(spark, d, *TALENT, shredded=False)["agg_talented_cast_member"]


@_reg("mart_agg_genre_evolution", "SELECT * FROM evolution")
def q_agg_genre_evolution(spark, d):
    out = world(spark, d, *GENRE)["agg_genre_evolution"]
    return out.select("genre_name", F.col("release_year").cast("bigint").alias("release_year"),
                      F.col("release_month").cast("bigint").alias("release_month"),
                      "average_popularity")


# --- serving queries (V1-V6) over the marts ----------------------------------------

@_reg("serve_trending", """
SELECT title, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, popularity, is_synthetic
FROM trends
""")
def q_serve_trending(spark, d):
    return serve.trending(world(spark, d, *TRENDS)["daily_movie_trends"])


@_reg("serve_genre_roi", """
SELECT genre_name, release_year, average_revenue_to_budget_ratio AS avg_roi, movie_count
FROM roi WHERE average_revenue_to_budget_ratio IS NOT NULL
""")
def q_serve_genre_roi(spark, d):
    out = serve.genre_roi(world(spark, d, *GENRE)["agg_genre_roi"], genres=None)
    return out.withColumn("release_year", F.col("release_year").cast("bigint"))


@_reg("serve_genre_margin", """
SELECT genre_name, release_year, average_profit_margin AS avg_profit_margin, movie_count
FROM roi WHERE average_profit_margin IS NOT NULL
  AND genre_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
""")
def q_serve_genre_margin(spark, d):
    genres = ("NATION_1", "NATION_2", "NATION_3", "NATION_4")
    out = serve.genre_margin(world(spark, d, *GENRE)["agg_genre_roi"], genres=genres)
    return out.withColumn("release_year", F.col("release_year").cast("bigint"))


@_reg("serve_talent", """
SELECT person_name, role_type, movie_count, average_vote_rating, average_revenue,
       rank() OVER (ORDER BY average_vote_rating DESC NULLS FIRST) <= 8 AS is_label
FROM talent WHERE average_revenue > 0 AND role_type IN ('actor', 'director')
""")
def q_serve_talent(spark, d):
    return serve.talent(world(spark, d, *TALENT, "agg_talented_cast_member", shredded=False)["agg_talented_cast_member"])


@_reg("serve_budget_tiers", """
SELECT budget_tier, average_revenue, average_rating, movie_count FROM outcomes
""")
def q_serve_budget_tiers(spark, d):
    return serve.budget_tiers(world(spark, d)["agg_budget_outcomes"])


@_reg("serve_genre_by_year", """
SELECT genre_name, release_year, ROUND(AVG(average_popularity), 6) AS avg_pop
FROM evolution GROUP BY 1, 2
""")
def q_serve_genre_by_year(spark, d):
    out = serve.genre_by_year(world(spark, d, *GENRE)["agg_genre_evolution"])
    # presentation precision: 6 decimals hide summation-order bits, no ties
    return out.select("genre_name", F.col("release_year").cast("bigint").alias("release_year"),
                      F.round("avg_pop", 6).alias("avg_pop"))


# --- profiling of the staged movies (F1-F5 with the profiler's own rules) -----------

@_reg("mart_profile_coverage", """
SELECT rule, k, n, CASE WHEN n = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) / n END AS rate FROM (
  SELECT 'budget > 0' AS rule, COUNT(*) FILTER (WHERE budget > 0) AS k, COUNT(*) AS n FROM stg
  UNION ALL SELECT 'revenue > 0', COUNT(*) FILTER (WHERE revenue > 0), COUNT(*) FROM stg
  UNION ALL SELECT 'runtime present', COUNT(*) FILTER (WHERE runtime <> 0), COUNT(*) FROM stg
  UNION ALL SELECT 'vote_count > 0', COUNT(*) FILTER (WHERE vote_count > 0), COUNT(*) FROM stg
  UNION ALL SELECT 'popularity present', COUNT(*) FILTER (WHERE popularity <> 0), COUNT(*) FROM stg
  UNION ALL SELECT 'overview present', COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL), COUNT(*) FROM stg
) t
""")
def q_profile_coverage(spark, d):
    stg = world(spark, d)["stg_movie_details"]
    return profile.coverage(stg, {
        "budget > 0": F.col("budget") > 0,
        "revenue > 0": F.col("revenue") > 0,
        "runtime present": profile.truthy("runtime_min"),
        "vote_count > 0": F.col("vote_count") > 0,
        "popularity present": profile.truthy("popularity"),
        "overview present": profile.truthy("overview"),
    })


@_reg("mart_profile_numeric", f"""
SELECT field, MIN(v) AS min, MAX(v) AS max, {_sround('AVG(v)', 1)} AS mean,
       {_sround('median(v)', 1)} AS median, COUNT(v) AS n
FROM (SELECT 'budget' AS field, NULLIF(CAST(budget AS DOUBLE), 0) AS v FROM stg
      UNION ALL SELECT 'revenue', NULLIF(CAST(revenue AS DOUBLE), 0) FROM stg
      UNION ALL SELECT 'runtime_min', NULLIF(CAST(runtime AS DOUBLE), 0) FROM stg
      UNION ALL SELECT 'vote_average', NULLIF(CAST(vote_average AS DOUBLE), 0) FROM stg
      UNION ALL SELECT 'vote_count', NULLIF(CAST(vote_count AS DOUBLE), 0) FROM stg
      UNION ALL SELECT 'popularity', NULLIF(popularity, 0) FROM stg) t
GROUP BY 1
""")
def q_profile_numeric(spark, d):
    stg = world(spark, d)["stg_movie_details"]
    return profile.numeric_stats(stg, ["budget", "revenue", "runtime_min", "vote_average",
                                       "vote_count", "popularity"])


@_reg("mart_profile_fanout", """
, sizes AS (
  SELECT m.movie_id, COALESCE(c.n, 0) AS cast_size, 1 AS crew_size
  FROM (SELECT DISTINCT movie_id FROM cells) m
  LEFT JOIN (SELECT movie_id, COUNT(*) AS n FROM cred_cast GROUP BY 1) c ON m.movie_id = c.movie_id)
SELECT 'cast' AS list, MIN(cast_size) AS min_size, CAST(FLOOR(median(cast_size)) AS BIGINT) AS median_size,
       MAX(cast_size) AS max_size, COUNT(*) AS parents FROM sizes
UNION ALL
SELECT 'crew', MIN(crew_size), CAST(FLOOR(median(crew_size)) AS BIGINT), MAX(crew_size), COUNT(*) FROM sizes
""")
def q_profile_fanout(spark, d):
    cr = world(spark, d)["stg_credits"]
    return profile.list_sizes(cr, {"cast": array_size(F.col("cast_list")),
                                   "crew": array_size(F.col("crew_list"))})


@_reg("mart_top_genres", """
SELECT genre_name, COUNT(*) AS n FROM int_genre GROUP BY 1 ORDER BY n DESC, genre_name LIMIT 10
""")
def q_top_genres(spark, d):
    return top_values(world(spark, d)["int_movie_genre"], "genre_name", 10)


@_reg("mart_top_companies", """
SELECT company_name, COUNT(*) AS n FROM int_company GROUP BY 1 ORDER BY n DESC, company_name LIMIT 10
""")
def q_top_companies(spark, d):
    return top_values(world(spark, d)["int_movie_company"], "company_name", 10)


# --- the declared data tests (D1-D7) over our own marts --------------------------------

# oracle CTE holding each model
_ORACLE_TABLE = {
    "stg_movie_details": "stg", "stg_credits": "stg_credits_o", "int_movie_genre": "int_genre",
    "int_movie_company": "int_company", "int_movie_cast": "int_cast",
    "int_movie_director": "int_dir", "dim_genre": "dim_genre", "dim_company": "dim_company_o",
    "dim_person": "dim_person", "fact_movie": "fact", "fact_movie_snapshot": "snapshot",
    "bridge_movie_genre": "bridge_genre", "bridge_movie_cast": "bridge_cast",
    "bridge_movie_director": "bridge_dir", "bridge_movie_company": "bridge_company_o",
    "daily_movie_trends": "trends", "agg_talented_cast_member": "talent", "agg_genre_roi": "roi",
    "agg_budget_outcomes": "outcomes", "agg_genre_evolution": "evolution",
}


def _check_sql(model, kind, column, arg) -> str:
    t = _ORACLE_TABLE[model]
    col = ",".join(column) if isinstance(column, tuple) else column
    if kind == "not_null":
        n = f"SELECT COUNT(*) FROM {t} WHERE {col} IS NULL"
    elif kind == "unique":
        n = (f"SELECT COUNT(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING COUNT(*) > 1)")
    elif kind == "unique_combination":
        n = f"SELECT COUNT(*) FROM (SELECT 1 FROM {t} GROUP BY {col} HAVING COUNT(*) > 1)"
    elif kind == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in arg)
        n = f"SELECT COUNT(*) FROM {t} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
    elif kind == "accepted_range":
        n = f"SELECT COUNT(*) FROM {t} WHERE NOT ({col} >= {arg[0]} AND {col} <= {arg[1]})"
    elif kind == "non_negative":
        n = f"SELECT COUNT(*) FROM {t} WHERE {col} < 0"
    else:  # relationships
        p, pc = _ORACLE_TABLE[arg[0]], arg[1]
        n = (f"SELECT COUNT(*) FROM {t} WHERE {col} IS NOT NULL AND {col} NOT IN "
             f"(SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)")
    return (f"SELECT '{kind}' AS check_name, '{model}' AS table_name, '{col}' AS column_name, "
            f"({n}) AS failures")


_DATA_TESTS_SQL = """
, stg_credits_o AS (SELECT cr.movie_id, ca.names AS cast_list, cr.names AS crew_list
  FROM (SELECT movie_id, list(person_name) AS names FROM crew GROUP BY 1) cr
  LEFT JOIN (SELECT movie_id, list(person_name) AS names FROM cred_cast GROUP BY 1) ca USING (movie_id)),
dim_company_o AS (SELECT DISTINCT company_id, company_name, origin_country FROM int_company),
bridge_company_o AS (SELECT DISTINCT movie_id, company_id FROM int_company)
""" + "\nUNION ALL ".join(_check_sql(*d) for d in DECLARED)


@_reg("mart_data_tests", _DATA_TESTS_SQL)
def q_data_tests(spark, d):
    return run_declared(world(spark, d, *EVERY, shredded=False))


# --- staging and intermediate models on their own (M1-M3) ------------------------------

@_reg("mart_stg_movie_details", f"""
, lists AS (
  SELECT movie_id,
         to_json(list(DISTINCT {{'id': CAST(s_nationkey AS BIGINT), 'name': n_name}}
                      ORDER BY {{'id': CAST(s_nationkey AS BIGINT), 'name': n_name}})) AS genres,
         to_json(list(DISTINCT {{'id': brand_no, 'name': p_brand,
                                 'origin_country': CASE WHEN brand_no < 5 THEN '' ELSE 'US' END}}
                      ORDER BY {{'id': brand_no, 'name': p_brand,
                                 'origin_country': CASE WHEN brand_no < 5 THEN '' ELSE 'US' END}})) AS companies
  FROM cells GROUP BY 1)
SELECT s.movie_id, strftime(s.release_date, '%Y-%m-%d') AS release_date, s.budget, s.revenue,
       CAST(s.vote_average AS DOUBLE) AS vote_average, s.vote_count, s.popularity,
       COALESCE(CAST(l.genres AS VARCHAR), '[]') AS genres,
       COALESCE(CAST(l.companies AS VARCHAR), '[]') AS production_companies,
       CASE WHEN s.o_custkey % 2 = 0 THEN '{{"id":' || substr(s.o_orderpriority, 1, 1) || ',"name":"'
            || s.o_orderpriority || '"}}' ELSE 'null' END AS movie_belongs_to_collection,
       strftime(s.ingested_at, {TS}) AS ingested_at
FROM stg s LEFT JOIN lists l ON s.movie_id = l.movie_id
""")
def q_stg_movie_details(spark, d):
    stg = world(spark, d)["stg_movie_details"]
    lists = ["genres", "production_companies", "movie_belongs_to_collection"]
    return stg.select("movie_id", "release_date", "budget", "revenue", "vote_average", "vote_count", "popularity",
                      *[F.to_json(F.col(c)).alias(c) for c in lists], "ingested_at")


@_reg("mart_stg_credits", """
SELECT cr.movie_id, COALESCE(c.n, 0) AS cast_members, COALESCE(c.people, 0) AS cast_ids, 1 AS crew_members,
       cr.name AS crew_name
FROM (SELECT movie_id, MIN(person_name) AS name FROM crew GROUP BY 1) cr
LEFT JOIN (SELECT movie_id, COUNT(*) AS n, CAST(SUM(person_id) AS BIGINT) AS people FROM cred_cast GROUP BY 1) c
  ON cr.movie_id = c.movie_id
""")
def q_stg_credits(spark, d):
    cr = world(spark, d)["stg_credits"]
    ids = F.aggregate(F.variant_get("cast_list", "$", "array<struct<id:bigint>>"), F.lit(0).cast("bigint"),
                      lambda acc, m: acc + m["id"])
    return cr.select("movie_id", array_size(F.col("cast_list")).alias("cast_members"), ids.alias("cast_ids"),
                     array_size(F.col("crew_list")).alias("crew_members"),
                     F.variant_get("crew_list", "$[0].name", "string").alias("crew_name"))


@_reg("mart_int_movie_genre", "SELECT * FROM int_genre")
def q_int_movie_genre(spark, d):
    return world(spark, d)["int_movie_genre"]


# --- the source path and incremental builds, on tables in the shared folder ------------

def _folder(spark, label: str) -> str:
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


@register("source_round_trip", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CASE WHEN c_custkey % 2 = 0 THEN '1995-01-01' ELSE '1995-01-02' END AS load_date, n_name AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_source_round_trip(spark, d):
    """Land JSON by run date, load, append by load day, read
    back, and join a seed CSV, through a view and a versioned table."""
    top = _folder(spark, "sources")
    cust = spark.read.parquet(f"{d}/customer.parquet")
    for odd, day in ((0, dt.date(1995, 1, 1)), (1, dt.date(1995, 1, 2))):
        land_payloads(cust.filter(F.col("c_custkey") % 2 == odd), top, "landed", day)
    for day in (dt.date(1995, 1, 1), dt.date(1995, 1, 2)):
        append_raw(load_raw(spark, f"{top}/landed", dt.datetime(day.year, day.month, day.day, 6), run_date=day), f"{top}/raw")
    spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey", "n_name").write.option("header", True).csv(f"{top}/seed")
    nation = read_seed(spark, f"{top}/seed", StructType().add("n_nationkey", "long").add("n_name", "string"))
    typed = extract(raw(spark, f"{top}/raw"), "raw_payload", [
        FieldSpec("id", "$.c_custkey", "int"), FieldSpec("name", "$.c_name", "string"),
        FieldSpec("balance", "$.c_acctbal", "double"), FieldSpec("segment", "$.c_mktsegment", "string"),
        FieldSpec("nation_id", "$.c_nationkey", "int")], keep=["load_date"])
    view = as_view(typed, "landed_customers")
    stored = as_table(view.join(nation, F.col("nation_id") == F.col("n_nationkey")), f"{top}/customers")
    return stored.select("id", "name", "balance", "segment", "load_date", F.col("n_name").alias("nation"))


@_reg("fact_incremental", f"""
SELECT movie_id, title, status, strftime(release_date, '%Y-%m-%d') AS release_date, budget, revenue,
       vote_count, popularity, strftime(ingested_at, {TS}) AS ingested_at
FROM fact
""")
def q_fact_incremental(spark, d):
    """M11 with S8: a first build from the first load of every order, then a
    merge of the later loads (and a repeat of it, which changes nothing)."""
    w, path = world(spark, d, "raw_movie_details"), _folder(spark, "fact")
    loads = w["raw_movie_details"]
    released = F.to_timestamp_ntz(F.variant_get("raw_payload", "$.release_date", "string"))
    first = F.col("ingested_at") < released + F.make_dt_interval(F.lit(0), F.lit(2))
    shifted = loads.withColumn("is_first", first)
    # the first build is stamped before every later load
    merge_fact(shifted.filter("is_first").withColumn("ingested_at", F.lit("1900-01-01").cast("timestamp_ntz")), path)
    merge_fact(loads, path)
    out = merge_fact(loads, path)
    return out.select("movie_id", "title", "status", "release_date", "budget", "revenue", "vote_count",
                      "popularity", "ingested_at")


@_reg("snapshot_incremental", """
SELECT movie_id, strftime(CAST(ingested_at AS DATE), '%Y-%m-%d') AS snapshot_date, popularity,
       CAST(vote_average AS DOUBLE) AS vote_average, vote_count, revenue, false AS is_synthetic
FROM (SELECT *, row_number() OVER (PARTITION BY movie_id, CAST(ingested_at AS DATE)
                                   ORDER BY ingested_at DESC) AS rn FROM det) WHERE rn = 1
""")
def q_snapshot_incremental(spark, d):
    """M12 with S8: a first build of the loads up to the middle day, then the
    later days (and a repeat, which adds nothing)."""
    w, path = world(spark, d, "raw_movie_details"), _folder(spark, "snapshot")
    loads = w["raw_movie_details"]
    day = F.unix_date(F.to_date("ingested_at"))
    middle = loads.agg(F.percentile_approx(day, 0.5).alias("m")).first()["m"]
    append_snapshot_days(spark, loads.filter(day <= F.lit(middle)), path)
    append_snapshot_days(spark, loads, path)
    append_snapshot_days(spark, loads, path)
    return snapshot_table(spark, path).select(*marts.SNAPSHOT_COLUMNS)


@_reg("seed_csv_build", """
SELECT movie_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, popularity,
       CAST(vote_average AS DOUBLE) AS vote_average, vote_count, revenue, is_synthetic
FROM snapshot
""")
def q_seed_csv_build(spark, d):
    """The synthetic history goes to a CSV, is read as the typed
    seed, and starts the snapshot table, in one commit."""
    w, top = world(spark, d, *SNAPSHOT, shredded=False), _folder(spark, "seeded")
    seed = read_seed(spark, write_seed(w["snapshot_seed"], f"{top}/seed"))
    append_snapshot_days(spark, w["raw_movie_details"], f"{top}/snapshot", w.cfg, seed)
    return snapshot_table(spark, f"{top}/snapshot").select(*marts.SNAPSHOT_COLUMNS)


@register("load_ledger", """
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '1995-01-01' ELSE '1995-01-02' END AS load_date
FROM customer
""")
def q_load_ledger(spark, d):
    """Landing files are loaded once, whatever is loaded again. The
    folder is loaded after each of two drops, and once more at the end."""
    top, cust = _folder(spark, "ledger"), spark.read.parquet(f"{d}/customer.parquet")
    first = F.col("c_custkey") % 3 == 0
    for part, day in ((first, dt.date(1995, 1, 1)), (~first, dt.date(1995, 1, 2)), (None, dt.date(1995, 1, 3))):
        if part is not None:
            land_payloads(cust.filter(part), top, "landed", day)
        load_new(spark, f"{top}/landed", f"{top}/raw", dt.datetime(day.year, day.month, day.day, 6))
    return extract(raw(spark, f"{top}/raw"), "raw_payload", [
        FieldSpec("id", "$.c_custkey", "int"), FieldSpec("name", "$.c_name", "string")],
        keep=["load_date"]).withColumn("load_date", F.col("load_date").cast("string"))


@register("load_stamp", "SELECT c_custkey AS id, true AS stamped_now FROM customer")
def q_load_stamp(spark, d):
    """Current timestamp default: rows loaded without a given time are stamped
    with the time of the load."""
    top, cust = _folder(spark, "stamp"), spark.read.parquet(f"{d}/customer.parquet")
    path = land_payloads(cust, top, "landed", dt.date(1995, 1, 1))
    load_new(spark, path, f"{top}/raw")
    near = F.expr("abs(timestampdiff(MINUTE, ingested_at, localtimestamp())) < 60").alias("stamped_now")
    rows = extract(raw(spark, f"{top}/raw"), "raw_payload", [FieldSpec("id", "$.c_custkey", "int")], keep=["ingested_at"])
    return rows.select("id", near)


# --- J1 / J2 over models stored by movie --------------------------------------------

@register("costored_trends", ORACLE["mart_daily_movie_trends"])
def q_costored_trends(spark, d):
    """The fact and the snapshot meet bucket by bucket."""
    w, co = world(spark, d, "raw_movie_details"), CoStored(spark, "movie_id")
    return marts.daily_movie_trends(co.put("fact", w["fact_movie"].select(*TREND_FACT)), co.put("snapshot", w["fact_movie_snapshot"]), w.cfg)


@register("costored_genre_evolution", ORACLE["mart_agg_genre_evolution"])
def q_costored_genre_evolution(spark, d):
    """The bridge and the fact meet bucket by bucket."""
    w, co = world(spark, d, *GENRE), CoStored(spark, "movie_id")
    out = marts.agg_genre_evolution(co.put("fact", w["fact_movie"]), co.put("genres", w["bridge_movie_genre"]),
                                    w["dim_genre"])
    return out.select("genre_name", F.col("release_year").cast("bigint").alias("release_year"),
                      F.col("release_month").cast("bigint").alias("release_month"), "average_popularity")
