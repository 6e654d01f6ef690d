"""Registered queries over the supplied tables, each with a SQL oracle.

Every query reads whole tables (or data Spark derives from them); no row
caps, id subsets or sampling. Each entry maps an operator of the inventory
onto the TPC-H-like tables (see the README for the mapping) and carries an
independent DuckDB SQL formulation of the same semantics.

Portability rules used on both sides of every comparison: integers are
BIGINT, DATE/TIMESTAMP outputs are ISO strings, money is integer cents,
and ``round(x, d)`` on DOUBLE is half-up on the decimal value (the oracle
spells that as a DECIMAL round, ``SROUND``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from reelmart.functions.columns import md5_bucket, zero_to_null
from reelmart.functions.payload import FieldSpec, extract
from reelmart.operators import history, incremental, quality, profile
from reelmart.operators.clustered import clustered, with_position
from reelmart.operators.explode import explode_payload
from reelmart.operators.heavy import heavy_values
from reelmart.operators.joins import union_distinct
from reelmart.operators.median import exact_median
from reelmart.operators.quality_change import run_by_change
from reelmart.operators.setops import reaggregate_mean
from reelmart.operators.windows import (choices, dense_top_n, latest_per_key, ordered, sample_first, sort_key, top_n_per_key,
                                        top_values, with_rank, yearly_catalogue)
from reelmart.plans import derive, marts
from reelmart.session import checkpoint_dir
from reelmart.sources.landing import as_table, load_checked
from reelmart.sources.tables import Versioned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def portable(df: DataFrame) -> DataFrame:
    """DATE/TIMESTAMP -> ISO strings, DECIMAL -> DOUBLE (same on the SQL side)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(100.0)).cast("bigint")


TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _sround(x: str, d: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def _iround_avg(x: str, d: int = 2) -> str:
    """Exact half-up rounding of avg(x) over integers, in integer arithmetic."""
    f = 10 ** d
    return (f"CAST(SIGN(SUM({x})) * ((2 * {f} * ABS(SUM({x})) + COUNT({x})) // "
            f"NULLIF(2 * COUNT({x}), 0)) AS DOUBLE) / {f}.0")


def _history_sql(src: str) -> str:
    """SELECT of the synthetic history formulas over ``src`` (columns
    movie_id, snapshot_date, months_ago, cur_pop, cur_va, cur_vc, cur_rev,
    phase, noise_k, spike_bucket): float curve, exact decimal drift/decay."""
    nx = "(CAST(noise_k AS DECIMAL(18,0)) * CAST(0.001 AS DECIMAL(4,3)))"
    ago = "CAST(months_ago AS DECIMAL(9,0))"
    noise = "(noise_k / 1000.0)"
    pop = (f"GREATEST(0.0, cur_pop * (0.70 + 0.45 * sin(2.0 * pi() * (CAST(months_ago AS DOUBLE) / 6.0"
           f" + phase))) * (0.90 + 0.20 * {noise}) * CASE WHEN spike_bucket < 8 THEN 1.6 + {noise}"
           f" ELSE 1.0 END)")
    return f"""SELECT movie_id, snapshot_date, {_sround(pop, 3)} AS popularity,
       CASE WHEN cur_va IS NULL THEN NULL ELSE CAST(LEAST(CAST(10 AS DECIMAL(4,2)), GREATEST(CAST(0 AS DECIMAL(4,2)),
            ROUND(CAST(cur_va AS DECIMAL(4,2)) + ({nx} - 0.5) * 0.15 - 0.02 * {ago}, 2))) AS DECIMAL(4,2)) END
         AS vote_average,
       CAST(ROUND(GREATEST(CAST(0 AS DECIMAL(38,6)), CAST(CAST(cur_vc AS DECIMAL(20,0)) * (1 - 0.004 * {ago})
            * (0.998 + 0.004 * {nx}) AS DECIMAL(38,6))), 0) AS BIGINT) AS vote_count,
       CAST(ROUND(CAST(CAST(cur_rev AS DECIMAL(20,0)) * (0.997 + 0.006 * {nx}) AS DECIMAL(38,6)), 0) AS BIGINT)
         AS revenue
FROM {src}"""


# --- P1 / P2 / J5 / S1 --------------------------------------------------------

@register("json_extract", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n
FROM events GROUP BY 1
""")
def q_json_extract(spark, d):
    ev = extract(T(spark, d, "events"), "props", [FieldSpec("k", "$.k", "int")])
    return ev.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


# --- P1 with rejects ----------------------------------------------------------

# Every 13th payload is cut, every 11th has a word for its price, every 7th no
# date for its date, every 5th lacks the customer, every 17th has a list for one.
_FAULTS = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS cust, o_orderpriority AS word, o_orderstatus AS status,
                  CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
"""


@register("payload_rejects", _FAULTS + """
, f AS (
  SELECT k, 'price' AS field, word AS raw_value, 'bad value' AS reason FROM o WHERE k % 11 = 0 AND k % 13 <> 0
  UNION ALL SELECT k, 'day', status || '-day', 'bad value' FROM o WHERE k % 7 = 0 AND k % 13 <> 0
  UNION ALL SELECT k, 'cust', '[' || CAST(cust AS VARCHAR) || ']', 'bad value' FROM o
            WHERE k % 17 = 0 AND k % 5 <> 0 AND k % 13 <> 0
  UNION ALL SELECT k, 'cust', NULL, 'missing' FROM o WHERE k % 5 = 0 AND k % 13 <> 0
  UNION ALL SELECT k, NULL, NULL, 'not json' FROM o WHERE k % 13 = 0)
SELECT k, field, raw_value, reason, CAST(NULL AS BIGINT) AS cents, CAST(NULL AS BIGINT) AS cust FROM f
UNION ALL
SELECT k, NULL, NULL, 'good', cents, CAST(cust AS BIGINT) FROM o WHERE k NOT IN (SELECT k FROM f)
""")
def q_payload_rejects(spark, d):
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    price = F.when(k % 11 == 0, F.to_json(F.struct(F.col("o_orderpriority").alias("p")))).otherwise(
        F.concat(F.lit('{"p":'), cents("o_totalprice").cast("string"), F.lit("}")))
    day = F.when(k % 7 == 0, F.concat("o_orderstatus", F.lit("-day"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    of = F.when(k % 5 == 0, F.lit("{}")).otherwise(F.concat(
        F.lit('{"c":'), F.when(k % 17 == 0, F.concat(F.lit("["), cust, F.lit("]"))).otherwise(cust), F.lit("}")))
    text = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"day":"'), day, F.lit('","price":'), price,
                    F.lit(',"by":'), of, F.lit("}"))
    landed = T(spark, d, "orders").select(
        k.alias("k"), F.when(k % 13 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("raw_payload"))
    good, bad = load_checked(landed, "raw_payload", [
        FieldSpec("id", "$.id", "int"), FieldSpec("day", "$.day", "date"), FieldSpec("price", "$.price.p", "int"),
        FieldSpec("cust", "$.by.c", "int")], keep=["k"], required=["id", "cust"])
    none = F.lit(None)
    text_free = F.when(F.col("reason") != "not json", F.col("raw_value"))  # a cut payload's text is long
    return bad.select("k", "field", text_free.alias("raw_value"), "reason", none.cast("bigint").alias("cents"),
                      none.cast("bigint").alias("cust")).unionByName(good.select(
                          "k", none.cast("string").alias("field"), none.cast("string").alias("raw_value"),
                          F.lit("good").alias("reason"), F.col("price").alias("cents"), "cust"))


@register("zero_to_null", """
SELECT l_returnflag, COUNT(*) AS n_lines, COUNT(NULLIF(l_discount, 0)) AS n_discounted,
       CAST(SUM(CAST(ROUND(NULLIF(l_discount, 0) * 100) AS BIGINT)) AS BIGINT) AS discount_pct_sum,
       AVG(CAST(ROUND(NULLIF(l_discount, 0) * 100) AS BIGINT)) AS avg_discount_pct
FROM lineitem GROUP BY 1
""")
def q_zero_to_null(spark, d):
    li = T(spark, d, "lineitem").select("l_returnflag", zero_to_null("l_discount").alias("disc"))
    pct = cents("disc")
    return li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("disc").alias("n_discounted"),
        F.sum(pct).alias("discount_pct_sum"), F.avg(pct).alias("avg_discount_pct"))


#: Lines that one document of ``payload_explode`` holds on average at most.
PART_LINES = 64


def line_documents(li: DataFrame) -> DataFrame:
    """One document per part of an order: ``id`` and its ``lines``.

    An order has one part per ``PART_LINES`` lines; a line's part follows from
    its hash. Only orders of several parts are joined back to the lines.
    """
    elem = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
                    F.col("l_quantity").alias("qty"))
    several = (li.groupBy(F.col("l_orderkey").alias("big")).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > PART_LINES)
               .select("big", F.ceil(F.col("n") / F.lit(PART_LINES)).alias("parts")))
    part = F.pmod(F.xxhash64(*li.columns), F.coalesce("parts", F.lit(1)).cast("bigint"))
    return (li.join(several, F.col("l_orderkey").eqNullSafe(F.col("big")), "left")
            .groupBy(F.col("l_orderkey").alias("id"), part.alias("part"))
            .agg(F.collect_list(elem).alias("lines")).select("id", "lines"))


@register("payload_explode", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no,
       l_partkey AS part_key, l_quantity AS quantity
FROM lineitem
""")
def q_payload_explode(spark, d):
    landed = line_documents(T(spark, d, "lineitem")).select(
        F.to_json(F.struct("id", "lines")).alias("raw_payload"))  # S1: one JSON string per document
    with_id = extract(landed, "raw_payload", [FieldSpec("order_id", "$.id", "int")],
                      keep=["raw_payload"])
    return explode_payload(with_id, "raw_payload", "$.lines",
                           [FieldSpec("line_no", "$.line", "int"),
                            FieldSpec("part_key", "$.part", "int"),
                            FieldSpec("quantity", "$.qty", "double")], keep=["order_id"])


# --- windows -------------------------------------------------------------------

@register("latest_per_user", f"""
SELECT user_id, event_id, strftime(ts, {TS}) AS ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST,
                               event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def q_latest_per_user(spark, d):
    ev = T(spark, d, "events")
    return latest_per_key(ev, ["user_id"], [sort_key("ts", desc=True)],
                          [F.col("event_id").desc()]).select(
        "user_id", "event_id", "ts", "event_type", "value")


@register("daily_last", """
SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS snapshot_date, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                               ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def q_daily_last(spark, d):
    ev = T(spark, d, "events").withColumn("snapshot_date", F.to_date("ts"))
    return latest_per_key(ev, ["user_id", "snapshot_date"], [sort_key("ts", desc=True)],
                          [F.col("event_id").desc()]).select(
        "user_id", "snapshot_date", "event_id", "value")


_LINE_TIEBREAK_SQL = ("l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, "
                      "l_returnflag, l_linestatus, l_shipdate")
_LINE_TIEBREAK = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]


@register("top_lines", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY CAST(l_quantity AS DECIMAL(38,0)) DESC NULLS FIRST, l_linenumber ASC NULLS LAST,
               {_LINE_TIEBREAK_SQL}) AS rn
  FROM lineitem) WHERE rn <= 3
""")
def q_top_lines(spark, d):
    li = T(spark, d, "lineitem")
    top = top_n_per_key(
        li, ["l_orderkey"],
        [sort_key(F.col("l_quantity").cast("decimal(38,0)"), desc=True, nulls_first=True),
         sort_key("l_linenumber", desc=False, nulls_first=False)],
        [F.col(c).asc_nulls_first() for c in _LINE_TIEBREAK], 3)
    return top.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@register("best_pair", f"""
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey
      ORDER BY l_extendedprice DESC NULLS FIRST, l_linenumber, {_LINE_TIEBREAK_SQL}) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_best_pair(spark, d):
    li = T(spark, d, "lineitem")
    best = latest_per_key(li, ["l_orderkey", "l_suppkey"],
                          [sort_key("l_extendedprice", desc=True)],
                          [F.col(c).asc_nulls_first() for c in ["l_linenumber", *_LINE_TIEBREAK]])
    return best.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_extendedprice")


# --- facts and marts on order analogues ------------------------------------------

def order_fact(spark, d) -> DataFrame:
    """Order analogue of the movie fact: money in integer cents.

    budget = sum of line prices, revenue = total price, rating = priority
    digit, votes = sum of line quantities. Orders without lines have an
    unknown budget.
    """
    li = T(spark, d, "lineitem")
    cost = li.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("budget"),
                                        F.sum("l_quantity").cast("bigint").alias("vote_count"))
    o = T(spark, d, "orders").select(
        F.col("o_orderkey").alias("movie_id"), F.to_date("o_orderdate").alias("release_date"),
        zero_to_null(cents("o_totalprice")).alias("revenue"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("vote_average"),
        cents("o_totalprice").alias("popularity"), F.col("o_custkey"))
    j = o.join(cost, F.col("movie_id") == F.col("l_orderkey"), "left").drop("l_orderkey")
    stg = j.withColumn("vote_count", F.coalesce("vote_count", F.lit(0)).cast("bigint"))
    rows = marts.fact_rows(stg.select(
        "movie_id", F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("original_title"),
        F.lit(None).cast("string").alias("original_language"),
        F.lit(None).cast("string").alias("status"), "release_date",
        F.lit(None).cast("bigint").alias("runtime_min"), "budget", "revenue", "vote_average",
        "vote_count", "popularity", F.lit(None).cast("string").alias("overview"),
        F.lit(None).cast("boolean").alias("video"), F.lit(None).cast("boolean").alias("adult"),
        F.lit(None).cast("string").alias("imdb_id"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at")))
    return rows


_ORDER_FACT_SQL = """
WITH cost AS (
  SELECT l_orderkey, CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS budget,
         CAST(SUM(l_quantity) AS BIGINT) AS vote_count
  FROM lineitem GROUP BY 1),
fact AS (
  SELECT o.o_orderkey AS movie_id, CAST(o.o_orderdate AS DATE) AS release_date,
         NULLIF(CAST(ROUND(o.o_totalprice * 100) AS BIGINT), 0) AS revenue,
         c.budget, COALESCE(c.vote_count, 0) AS vote_count,
         CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS vote_average,
         CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS popularity, o.o_custkey
  FROM orders o LEFT JOIN cost c ON o.o_orderkey = c.l_orderkey),
f AS (
  SELECT *, (budget IS NOT NULL AND revenue IS NOT NULL) AS has_financial_data,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL
              THEN CAST(revenue AS DOUBLE) / NULLIF(CAST(budget AS DOUBLE), 0) END
              AS revenue_to_budget_ratio,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL
              THEN CAST(revenue - budget AS DOUBLE) / NULLIF(CAST(budget AS DOUBLE), 0) END
              AS profit_margin,
         CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL THEN revenue - budget END AS profit
  FROM fact)
"""


@register("order_finance", _ORDER_FACT_SQL + """
SELECT movie_id AS o_orderkey, budget, revenue, has_financial_data, revenue_to_budget_ratio,
       profit_margin, profit FROM f
""")
def q_order_finance(spark, d):
    f = order_fact(spark, d)
    return f.select(F.col("movie_id").alias("o_orderkey"), "budget", "revenue",
                    "has_financial_data", "revenue_to_budget_ratio", "profit_margin", "profit")


# Tier cut points for the order analogue (in cents).
ORDER_TIER_BOUNDS = (10_000_000, 25_000_000, 40_000_000)
ORDER_TIER_LABELS = ("1: <$100K", "2: $100K-$250K", "3: $250K-$400K", "4: >$400K")


@register("tier_outcomes", _ORDER_FACT_SQL + f"""
SELECT CASE WHEN budget < 10000000 THEN '1: <$100K'
            WHEN budget < 25000000 THEN '2: $100K-$250K'
            WHEN budget < 40000000 THEN '3: $250K-$400K'
            ELSE '4: >$400K' END AS budget_tier,
       COUNT(*) AS movie_count,
       CAST(SUM(COALESCE(revenue, 0)) AS BIGINT) AS total_revenue,
       {_iround_avg('revenue')} AS average_revenue,
       {_iround_avg('profit')} AS average_profit,
       {_iround_avg('vote_average')} AS average_rating
FROM f WHERE has_financial_data = true GROUP BY 1
""")
def q_tier_outcomes(spark, d):
    return marts.agg_budget_outcomes(order_fact(spark, d), ORDER_TIER_BOUNDS, ORDER_TIER_LABELS)


_NATION_BRIDGE_SQL = """
bridge AS (SELECT DISTINCT l.l_orderkey AS movie_id, s.s_nationkey AS genre_id
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
dim AS (SELECT DISTINCT n_nationkey AS genre_id, n_name AS genre_name FROM nation)
"""


def nation_bridge(spark, d) -> tuple[DataFrame, DataFrame]:
    """Genre analogue: the nations of an order's suppliers."""
    li = T(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    bridge = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
              .select(F.col("l_orderkey").alias("movie_id"),
                      F.col("s_nationkey").cast("bigint").alias("genre_id")).distinct())
    dim = marts.dim_genre(T(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("genre_id"), F.col("n_name").alias("genre_name")))
    return bridge, dim


@register("nation_year_star", """
SELECT n.n_name, CAST(year(o.o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS line_count,
       CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2
""")
def q_nation_year_star(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nat = T(spark, d, "nation").select("n_nationkey", "n_name")  # 25 rows by schema
    o = T(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
         .join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner"))
    return j.groupBy("n_name", F.year("o_orderdate").cast("bigint").alias("order_year")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(cents("l_extendedprice")).alias("revenue_cents"))


@register("priority_year_median", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS order_count,
       median(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS median_cents,
       AVG(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS avg_cents
FROM orders GROUP BY 1, 2
""")
def q_priority_year_median(spark, d):
    o = T(spark, d, "orders").select(
        "o_orderpriority", F.year("o_orderdate").cast("bigint").alias("order_year"),
        cents("o_totalprice").alias("c"))
    keys = ["o_orderpriority", "order_year"]
    base = o.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"),
                                F.avg("c").alias("avg_cents"))
    med = exact_median(o, keys, "c", "median_cents")
    return base.join(med, keys, "inner")


@register("genre_roi_orders", _ORDER_FACT_SQL + "," + _NATION_BRIDGE_SQL + f"""
, rows AS (
  SELECT d.genre_name, CAST(year(f.release_date) AS BIGINT) AS release_year,
         CASE WHEN f.has_financial_data THEN f.revenue_to_budget_ratio END AS roi,
         CASE WHEN f.has_financial_data THEN f.profit_margin END AS pm
  FROM bridge b JOIN dim d ON b.genre_id = d.genre_id
  JOIN f ON b.movie_id = f.movie_id WHERE f.release_date IS NOT NULL)
SELECT genre_name, release_year, COUNT(*) AS movie_count,
       COUNT(roi) AS movie_count_with_financial_data,
       {_sround('AVG(roi)', 2)} AS average_revenue_to_budget_ratio,
       {_sround('AVG(pm)', 2)} AS average_profit_margin,
       {_sround('median(roi)', 2)} AS median_revenue_to_budget_ratio,
       {_sround('median(pm)', 2)} AS median_profit_margin
FROM rows GROUP BY 1, 2
""")
def q_genre_roi_orders(spark, d):
    bridge, dim = nation_bridge(spark, d)
    out = marts.agg_genre_roi(order_fact(spark, d), bridge, dim)
    return out.withColumn("release_year", F.col("release_year").cast("bigint"))


@register("nation_month", _ORDER_FACT_SQL + "," + _NATION_BRIDGE_SQL + f"""
SELECT d.genre_name, CAST(year(f.release_date) AS BIGINT) AS release_year,
       CAST(month(f.release_date) AS BIGINT) AS release_month,
       {_iround_avg('f.popularity')} AS average_popularity
FROM bridge b JOIN dim d ON b.genre_id = d.genre_id JOIN f ON b.movie_id = f.movie_id
WHERE f.release_date IS NOT NULL GROUP BY 1, 2, 3
""")
def q_nation_month(spark, d):
    bridge, dim = nation_bridge(spark, d)
    out = marts.agg_genre_evolution(order_fact(spark, d), bridge, dim)
    return out.select("genre_name", F.col("release_year").cast("bigint").alias("release_year"),
                      F.col("release_month").cast("bigint").alias("release_month"),
                      "average_popularity")


@register("avg_of_avgs", _ORDER_FACT_SQL + "," + _NATION_BRIDGE_SQL + f"""
, monthly AS (
  SELECT d.genre_name, year(f.release_date) AS release_year, month(f.release_date) AS m,
         SIGN(SUM(f.popularity)) * ((200 * ABS(SUM(f.popularity)) + COUNT(f.popularity))
             // (2 * COUNT(f.popularity))) AS avg_pop_x100
  FROM bridge b JOIN dim d ON b.genre_id = d.genre_id JOIN f ON b.movie_id = f.movie_id
  WHERE f.release_date IS NOT NULL GROUP BY 1, 2, 3)
SELECT genre_name, CAST(release_year AS BIGINT) AS release_year,
       CAST(SIGN(SUM(avg_pop_x100)) * ((2 * 10000 * ABS(SUM(avg_pop_x100)) + 100 * COUNT(*))
            // (2 * 100 * COUNT(*))) AS DOUBLE) / 10000.0 AS avg_pop
FROM monthly GROUP BY 1, 2
""")
def q_avg_of_avgs(spark, d):
    bridge, dim = nation_bridge(spark, d)
    monthly = marts.agg_genre_evolution(order_fact(spark, d), bridge, dim)
    yearly = reaggregate_mean(monthly, ["genre_name", "release_year"], "average_popularity",
                              "avg_pop")
    return yearly.select("genre_name", F.col("release_year").cast("bigint").alias("release_year"),
                         F.round("avg_pop", 4).alias("avg_pop"))


# --- talent (M16) analogue --------------------------------------------------------

def talent_inputs(spark, d):
    """Persons: suppliers act in orders, customers direct them (ids offset)."""
    li = T(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    cast = li.select(F.col("l_orderkey").alias("movie_id"),
                     F.col("l_suppkey").alias("person_id")).distinct()
    o = T(spark, d, "orders")
    directors = o.select(F.col("o_orderkey").alias("movie_id"),
                         (F.col("o_custkey") + F.lit(CUSTOMER_PERSON_OFFSET)).alias("person_id"),
                         F.lit("Director").alias("job"))
    persons = (T(spark, d, "supplier").select(F.col("s_suppkey").alias("person_id"),
                                              F.col("s_name").alias("person_name"))
               .unionByName(T(spark, d, "customer").select(
                   (F.col("c_custkey") + F.lit(CUSTOMER_PERSON_OFFSET)).alias("person_id"),
                   F.col("c_name").alias("person_name"))))
    return cast, directors, persons


CUSTOMER_PERSON_OFFSET = 1 << 40

_TALENT_SQL = _ORDER_FACT_SQL + f"""
, gm AS (SELECT AVG(vote_average) AS g FROM f WHERE vote_count > 50),
w AS (SELECT f.movie_id, f.revenue,
             (CAST(f.vote_average AS DOUBLE) * f.vote_count + gm.g * 50.0) / (f.vote_count + 50.0)
               AS wr FROM f CROSS JOIN gm),
roles AS (SELECT DISTINCT l_suppkey AS person_id, l_orderkey AS movie_id, 'actor' AS role_type
          FROM lineitem
          UNION ALL
          SELECT o_custkey + {1 << 40} AS person_id, o_orderkey AS movie_id, 'director' AS role_type
          FROM orders),
persons AS (SELECT s_suppkey AS person_id, s_name AS person_name FROM supplier
            UNION ALL SELECT c_custkey + {1 << 40}, c_name FROM customer)
"""


@register("bayes_by_supplier", _TALENT_SQL + f"""
SELECT r.person_id, p.person_name, r.role_type, COUNT(*) AS movie_count,
       {_sround('AVG(w.wr)', 2)} AS average_vote_rating,
       {_iround_avg('w.revenue')} AS average_revenue
FROM roles r JOIN persons p ON p.person_id = r.person_id JOIN w ON w.movie_id = r.movie_id
GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5
""")
def q_bayes_by_supplier(spark, d):
    cast, directors, persons = talent_inputs(spark, d)
    return marts.agg_talented_cast_member(order_fact(spark, d), cast, directors, persons)


@register("roles_having", """
SELECT person_id, role, COUNT(*) AS n FROM (
  SELECT o_custkey AS person_id, 'customer' AS role FROM orders
  UNION ALL SELECT l_suppkey, 'supplier' FROM lineitem) t
GROUP BY 1, 2 HAVING COUNT(*) >= 5
""")
def q_roles_having(spark, d):
    roles = (T(spark, d, "orders").select(F.col("o_custkey").alias("person_id"),
                                          F.lit("customer").alias("role"))
             .unionByName(T(spark, d, "lineitem").select(F.col("l_suppkey").alias("person_id"),
                                                         F.lit("supplier").alias("role"))))
    return (roles.groupBy("person_id", "role").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= 5))


@register("people_union", """
SELECT n_name AS name FROM nation UNION SELECT r_name FROM region
""")
def q_people_union(spark, d):
    return union_distinct(T(spark, d, "nation").select(F.col("n_name").alias("name")),
                          T(spark, d, "region").select(F.col("r_name").alias("name")))


@register("dense_top", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice,
         dense_rank() OVER (ORDER BY o_totalprice DESC NULLS FIRST) AS r FROM orders)
WHERE r <= 10
""")
def q_dense_top(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return dense_top_n(o, "o_totalprice", 10)


def event_movies(spark, d):
    """Trend analogue: a user is a movie; its daily last event a snapshot."""
    ev = T(spark, d, "events")
    fact = ev.groupBy("user_id").agg(F.max("value").alias("popularity"),
                                     F.count(F.lit(1)).alias("vote_count")).select(
        F.col("user_id").alias("movie_id"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("title"),
        F.col("user_id").alias("budget"), "popularity", "vote_count")
    snaps = latest_per_key(ev.withColumn("snapshot_date", F.to_date("ts")),
                           ["user_id", "snapshot_date"], [sort_key("ts", desc=True)],
                           [F.col("event_id").desc()])
    snapshot = snaps.select(F.col("user_id").alias("movie_id"), "snapshot_date",
                            F.col("value").alias("popularity"),
                            F.lit(None).cast("decimal(4,2)").alias("vote_average"),
                            F.col("event_id").alias("vote_count"),
                            F.lit(None).cast("bigint").alias("revenue"),
                            F.lit(False).alias("is_synthetic"))
    return fact, snapshot


@register("trend_join", """
WITH fact AS (SELECT user_id AS movie_id, 'User ' || CAST(user_id AS VARCHAR) AS title,
                     user_id AS budget, MAX(value) AS popularity, COUNT(*) AS vote_count
              FROM events GROUP BY user_id),
snap AS (SELECT user_id AS movie_id, CAST(ts AS DATE) AS snapshot_date, value AS popularity,
                event_id AS vote_count FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                        ORDER BY ts DESC, event_id DESC) AS rn FROM events)
         WHERE rn = 1)
SELECT movie_id, snapshot_date, title, budget, latest_popularity, popularity, vote_average,
       vote_count, revenue, is_synthetic FROM (
  SELECT m.movie_id, strftime(d.snapshot_date, '%Y-%m-%d') AS snapshot_date, m.title, m.budget,
         m.popularity AS latest_popularity, d.popularity, CAST(NULL AS DOUBLE) AS vote_average,
         d.vote_count, CAST(NULL AS BIGINT) AS revenue, false AS is_synthetic,
         dense_rank() OVER (ORDER BY m.popularity DESC NULLS FIRST) AS r
  FROM fact m JOIN snap d ON m.movie_id = d.movie_id WHERE m.vote_count > 50) WHERE r <= 10
""")
def q_trend_join(spark, d):
    fact, snapshot = event_movies(spark, d)
    return marts.daily_movie_trends(fact, snapshot)


@register("label_rank", """
SELECT s_suppkey, s_name, s_acctbal, rank FROM (
  SELECT *, rank() OVER (ORDER BY s_acctbal DESC NULLS FIRST) AS rank FROM supplier)
WHERE rank <= 8
""")
def q_label_rank(spark, d):
    s = T(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return with_rank(s, "s_acctbal", 8, "rank").withColumn("rank", F.col("rank").cast("bigint"))


# --- incremental -------------------------------------------------------------------

# The day that splits the event stream into a "previous run"
# (before) and the new loads (from then on).
EVENT_SPLIT = "2024-01-15"


@register("after_watermark", f"""
SELECT event_id, user_id, strftime(ts, {TS}) AS ts FROM events
WHERE ts > (SELECT COALESCE(MAX(ts), TIMESTAMP '2024-01-01 00:00:00')
            FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT} 00:00:00')
""")
def q_after_watermark(spark, d):
    ev = T(spark, d, "events")
    target = ev.filter(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz"))
    fresh = incremental.new_rows(ev, "ts", target, dt.datetime(2024, 1, 1))
    return fresh.select("event_id", "user_id", "ts")


@register("upsert_latest", f"""
WITH early AS (SELECT user_id, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
    FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT} 00:00:00') WHERE rn = 1),
late AS (SELECT user_id, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
    FROM events WHERE ts >= TIMESTAMP '{EVENT_SPLIT} 00:00:00') WHERE rn = 1)
SELECT COALESCE(l.user_id, e.user_id) AS user_id,
       CASE WHEN l.user_id IS NOT NULL THEN l.event_id ELSE e.event_id END AS event_id,
       strftime(CASE WHEN l.user_id IS NOT NULL THEN l.ts ELSE e.ts END, {TS}) AS ts,
       CASE WHEN l.user_id IS NOT NULL THEN l.value ELSE e.value END AS value
FROM early e FULL OUTER JOIN late l ON e.user_id = l.user_id
""")
def q_upsert_latest(spark, d):
    ev = T(spark, d, "events")
    split = F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    order = [sort_key("ts", desc=True)]
    tb = [F.col("event_id").desc()]
    early = latest_per_key(ev.filter(F.col("ts") < split), ["user_id"], order, tb)
    late = latest_per_key(ev.filter(F.col("ts") >= split), ["user_id"], order, tb)
    cols = ["user_id", "event_id", "ts", "value"]
    return incremental.upsert(early.select(*cols), late.select(*cols), ["user_id"])


# --- history -----------------------------------------------------------------------

def _anchor(spark, d) -> DataFrame:
    """The run date of the history queries: the last order date (one row)."""
    return T(spark, d, "orders").agg(F.to_date(F.max("o_orderdate")).alias("today"))


_SPINE_SQL = """
anchor AS (SELECT date_trunc('month', CAST(MAX(o_orderdate) AS DATE)) AS m0 FROM orders),
spine AS (SELECT CAST(m0 - INTERVAL (k) MONTH AS DATE) AS snapshot_date, CAST(k AS BIGINT) AS months_ago
          FROM anchor, range(2, 7) t(k))
"""


@register("month_spine", "WITH " + _SPINE_SQL + """
SELECT s.s_suppkey, strftime(p.snapshot_date, '%Y-%m-%d') AS snapshot_date, p.months_ago
FROM supplier s CROSS JOIN spine p
""")
def q_month_spine(spark, d):
    spine = history.month_spine_from(_anchor(spark, d), "today", 6, 1)
    s = T(spark, d, "supplier").select("s_suppkey")
    return s.crossJoin(F.broadcast(spine)).select(
        "s_suppkey", "snapshot_date", F.col("months_ago").cast("bigint").alias("months_ago"))


def _md5_sql(expr: str, n: int) -> str:
    return f"(CAST(('0x' || substr(md5({expr}), 1, 15)) AS BIGINT) % {n})"


@register("md5_noise", f"""
SELECT s_suppkey, {_md5_sql('CAST(s_suppkey AS VARCHAR)', 1000)} AS phase_bucket FROM supplier
""")
def q_md5_noise(spark, d):
    s = T(spark, d, "supplier")
    return s.select("s_suppkey", md5_bucket(1000, "s_suppkey").alias("phase_bucket"))


def supplier_movies(spark, d) -> DataFrame:
    """Current values of a supplier 'movie' for the history synthesiser."""
    s = T(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("movie_id"),
                    (F.col("s_acctbal") / F.lit(100.0)).alias("popularity"),
                    F.pmod(F.col("s_nationkey"), F.lit(10)).cast("decimal(4,2)").alias("vote_average"),
                    (F.col("s_suppkey") * F.lit(7)).alias("vote_count"),
                    zero_to_null(F.round("s_acctbal").cast("bigint")).alias("revenue"))


@register("synthetic_history", "WITH " + _SPINE_SQL + f"""
, m AS (SELECT s_suppkey AS movie_id, s_acctbal / 100.0 AS cur_pop,
               CAST(s_nationkey % 10 AS DECIMAL(4,2)) AS cur_va, s_suppkey * 7 AS cur_vc,
               NULLIF(CAST(ROUND(s_acctbal) AS BIGINT), 0) AS cur_rev FROM supplier),
g AS (SELECT m.*, p.snapshot_date, p.months_ago,
             {_md5_sql('CAST(m.movie_id AS VARCHAR)', 1000)} / 1000.0 AS phase,
             {_md5_sql("CAST(m.movie_id AS VARCHAR) || '|' || CAST(p.months_ago AS VARCHAR)", 1000)} AS noise_k,
             {_md5_sql("CAST(m.movie_id AS VARCHAR) || '|' || CAST(p.months_ago AS VARCHAR) || '|7'", 100)}
               AS spike_bucket
      FROM m CROSS JOIN spine p WHERE m.cur_pop IS NOT NULL),
h AS ({_history_sql('g')})
SELECT movie_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, popularity,
       CAST(vote_average AS DOUBLE) AS vote_average, vote_count, revenue FROM h
""")
def q_synthetic_history(spark, d):
    return history.synthetic_history_from(supplier_movies(spark, d), _anchor(spark, d), "today")


@register("yearly_cap", """
SELECT DISTINCT o_orderkey FROM (
  SELECT o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate)
      ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS rn FROM orders) WHERE rn <= 100
""")
def q_yearly_cap(spark, d):
    o = T(spark, d, "orders")
    return yearly_catalogue(o, "o_orderkey", "o_orderdate", [sort_key("o_totalprice", desc=True)],
                            100, [F.col("o_orderkey").asc()])


@register("sample_ids", """
SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 150
""")
def q_sample_ids(spark, d):
    # T4: the profiler's first-n sample (the limit is the feature)
    o = T(spark, d, "orders")
    return sample_first(o, [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()], 150).select(
        "o_orderkey")


@register("json_roundtrip", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def q_json_roundtrip(spark, d):
    # S1 + S2 + P1: records -> JSON strings -> VARIANT -> typed fields
    c = T(spark, d, "customer")
    landed = c.select(F.to_json(F.struct(*[F.col(x) for x in c.columns])).alias("raw_payload"))
    return extract(landed, "raw_payload", [
        FieldSpec("c_custkey", "$.c_custkey", "int"), FieldSpec("c_name", "$.c_name", "string"),
        FieldSpec("c_nationkey", "$.c_nationkey", "int"),
        FieldSpec("c_acctbal", "$.c_acctbal", "double"),
        FieldSpec("c_mktsegment", "$.c_mktsegment", "string")])


@register("choices", "SELECT DISTINCT n_name FROM nation")
def q_choices(spark, d):
    return choices(T(spark, d, "nation"), "n_name")


# --- profiling -----------------------------------------------------------------------

@register("coverage", """
SELECT rule, k, n, CASE WHEN n = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) / n END AS rate FROM (
  SELECT 'discount > 0' AS rule, COUNT(*) FILTER (WHERE l_discount > 0) AS k, COUNT(*) AS n FROM lineitem
  UNION ALL SELECT 'tax > 0', COUNT(*) FILTER (WHERE l_tax > 0), COUNT(*) FROM lineitem
  UNION ALL SELECT 'quantity present', COUNT(*) FILTER (WHERE l_quantity IS NOT NULL AND l_quantity <> 0), COUNT(*) FROM lineitem
  UNION ALL SELECT 'returnflag present', COUNT(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag <> ''), COUNT(*) FROM lineitem
) t
""")
def q_coverage(spark, d):
    li = T(spark, d, "lineitem")
    return profile.coverage(li, {
        "discount > 0": F.col("l_discount") > 0,
        "tax > 0": F.col("l_tax") > 0,
        "quantity present": profile.truthy("l_quantity"),
        "returnflag present": profile.truthy("l_returnflag"),
    })


@register("numeric_stats", f"""
SELECT field, MIN(v) AS min, MAX(v) AS max, {_sround('AVG(v)', 1)} AS mean,
       {_sround('median(v)', 1)} AS median, COUNT(v) AS n
FROM (SELECT 'l_quantity' AS field, NULLIF(l_quantity, 0) AS v FROM lineitem
      UNION ALL SELECT 'l_extendedprice', NULLIF(l_extendedprice, 0) FROM lineitem
      UNION ALL SELECT 'l_discount', NULLIF(l_discount, 0) FROM lineitem
      UNION ALL SELECT 'l_tax', NULLIF(l_tax, 0) FROM lineitem) t
GROUP BY 1
""")
def q_numeric_stats(spark, d):
    li = T(spark, d, "lineitem")
    return profile.numeric_stats(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("fanout_size", """
SELECT MIN(n) AS min_size, CAST(FLOOR(median(n)) AS BIGINT) AS median_size, MAX(n) AS max_size,
       COUNT(*) AS parents
FROM (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1) t
""")
def q_fanout_size(spark, d):
    sizes = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return profile.size_stats(sizes, "n")


@register("genre_fanout", f"""
WITH per AS (SELECT l.l_orderkey, COUNT(DISTINCT s.s_nationkey) AS g
             FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1)
SELECT (SELECT COUNT(DISTINCT s.s_nationkey) FROM lineitem l JOIN supplier s
          ON l.l_suppkey = s.s_suppkey) AS distinct_values,
       {_iround_avg('g')} AS avg_per_parent,
       (SELECT COUNT(DISTINCT l_partkey) FROM lineitem) AS distinct_other
FROM per
""")
def q_genre_fanout(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    sup = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    pairs = li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    return profile.fanout_stats(pairs, "l_orderkey", "s_nationkey", li, "l_partkey")


@register("top_values", """
SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3
""")
def q_top_values(spark, d):
    return top_values(T(spark, d, "events"), "event_type", 3)


@register("heavy_values", """
SELECT * FROM (SELECT 'part' AS field, CAST(l_partkey AS VARCHAR) AS value, COUNT(*) AS n FROM lineitem
               WHERE l_partkey IS NOT NULL GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 25)
UNION ALL
SELECT * FROM (SELECT 'price', CAST(cents AS VARCHAR), COUNT(*) AS n
               FROM (SELECT CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
               WHERE cents IS NOT NULL GROUP BY cents ORDER BY n DESC, cents LIMIT 25)
""")
def q_heavy_values(spark, d):
    li = T(spark, d, "lineitem")
    part = heavy_values(li, "l_partkey", 25).select(F.lit("part").alias("field"), F.col("l_partkey").cast("string").alias("value"), "n")
    price = heavy_values(li.select(cents("l_extendedprice").alias("cents")), "cents", 25)
    return part.unionByName(price.select(F.lit("price").alias("field"), F.col("cents").cast("string").alias("value"), "n"))


# --- data quality ---------------------------------------------------------------------

@register("dq_not_null", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NULLIF(l_discount, 0) IS NULL
""")
def q_dq_not_null(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                        zero_to_null("l_discount").alias("discount"))
    return quality.failing(li, quality.NotNull("discount")).drop("discount")


@register("dq_unique", """
SELECT l_orderkey AS unique_field, COUNT(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1
""")
def q_dq_unique(spark, d):
    return quality.failing(T(spark, d, "lineitem"), quality.Unique("l_orderkey"))


@register("dq_combo", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def q_dq_combo(spark, d):
    return quality.failing(T(spark, d, "lineitem"),
                           quality.UniqueCombination(("l_orderkey", "l_linenumber")))


@register("dq_values", """
SELECT o_orderstatus AS value_field, COUNT(*) AS n_records FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY 1
""")
def q_dq_values(spark, d):
    return quality.failing(T(spark, d, "orders"),
                           quality.AcceptedValues("o_orderstatus", ("F", "O")))


@register("dq_orphans", """
SELECT o_orderkey FROM orders
WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem
                                                    WHERE l_orderkey IS NOT NULL)
""")
def q_dq_orphans(spark, d):
    rule = quality.Relationship("o_orderkey", T(spark, d, "lineitem"), "l_orderkey")
    return quality.failing(T(spark, d, "orders").select("o_orderkey"), rule)


@register("dq_range", """
SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE NOT (l_tax >= 0 AND l_tax <= 0.05)
""")
def q_dq_range(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    return quality.failing(li, quality.AcceptedRange("l_tax", 0, 0.05))


@register("dq_nonneg", """
SELECT * FROM customer WHERE c_acctbal < 0
""")
def q_dq_nonneg(spark, d):
    return quality.failing(T(spark, d, "customer"), quality.NonNegative("c_acctbal"))


@register("dq_summary", """
SELECT 'not_null' AS check_name, 'orders' AS table_name, 'o_orderdate' AS column_name,
       COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS failures FROM orders
UNION ALL SELECT 'accepted_values', 'orders', 'o_orderstatus',
       COUNT(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'non_negative', 'orders', 'o_totalprice', COUNT(*) FILTER (WHERE o_totalprice < 0) FROM orders
UNION ALL SELECT 'non_negative', 'customer', 'c_acctbal', COUNT(*) FILTER (WHERE c_acctbal < 0) FROM customer
UNION ALL SELECT 'accepted_range', 'lineitem', 'l_discount',
       COUNT(*) FILTER (WHERE NOT (l_discount >= 0 AND l_discount <= 0.1)) FROM lineitem
UNION ALL SELECT 'unique', 'orders', 'o_orderkey', (SELECT COUNT(*) FROM (
       SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'unique_combination', 'lineitem', 'l_orderkey,l_linenumber', (SELECT COUNT(*) FROM (
       SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1))
UNION ALL SELECT 'relationships', 'lineitem', 'l_orderkey', (SELECT COUNT(*) FROM lineitem
       WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders
                                                           WHERE o_orderkey IS NOT NULL))
""")
def q_dq_summary(spark, d):
    o, c, li = T(spark, d, "orders"), T(spark, d, "customer"), T(spark, d, "lineitem")
    checks = [
        ("orders", o, quality.NotNull("o_orderdate")),
        ("orders", o, quality.AcceptedValues("o_orderstatus", ("F", "O"))),
        ("orders", o, quality.NonNegative("o_totalprice")),
        ("customer", c, quality.NonNegative("c_acctbal")),
        ("lineitem", li, quality.AcceptedRange("l_discount", 0, 0.1)),
        ("orders", o, quality.Unique("o_orderkey")),
        ("lineitem", li, quality.UniqueCombination(("l_orderkey", "l_linenumber"))),
        ("lineitem", li, quality.Relationship("l_orderkey", o, "o_orderkey")),
    ]
    return quality.run_checks(checks)


_CHANGED_ORDERS = """
WITH before AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 1 AS run FROM orders),
late AS (SELECT * FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)),
after AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 2 AS run FROM orders
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)
  UNION ALL SELECT o_orderkey, -o_custkey, 'X', -o_totalprice, 2 FROM late),
o AS (SELECT * FROM before UNION ALL SELECT * FROM after)
"""


@register("dq_by_change", _CHANGED_ORDERS + """
SELECT run, 'unique' AS check_name, 'o_orderkey' AS column_name,
       COUNT(*) FILTER (n > 1) AS failures
FROM (SELECT run, o_orderkey, COUNT(*) AS n FROM o WHERE o_orderkey IS NOT NULL GROUP BY 1, 2) GROUP BY 1
UNION ALL SELECT run, 'not_null', 'o_custkey', COUNT(*) FILTER (o_custkey IS NULL) FROM o GROUP BY 1
UNION ALL SELECT run, 'accepted_values', 'o_orderstatus', COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P'))
FROM o GROUP BY 1
UNION ALL SELECT run, 'non_negative', 'o_totalprice', COUNT(*) FILTER (o_totalprice < 0) FROM o GROUP BY 1
UNION ALL SELECT run, 'relationships', 'o_custkey',
       COUNT(*) FILTER (o_custkey IS NOT NULL AND c_custkey IS NULL)
FROM o LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def q_dq_by_change(spark, d):
    # D1-D5 after the first load and after a merge of the last day's orders
    path = f"{checkpoint_dir(spark)}/dq-{uuid.uuid4().hex}"
    table, ledger = Versioned(spark, f"{path}/orders"), Versioned(spark, f"{path}/ledger")
    orders = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    rules = [quality.Unique("o_orderkey"), quality.NotNull("o_custkey"),
             quality.AcceptedValues("o_orderstatus", ("F", "O", "P")), quality.NonNegative("o_totalprice"),
             quality.Relationship("o_custkey", T(spark, d, "customer"), "c_custkey")]

    def run(n: int) -> DataFrame:
        out = run_by_change(table, ledger, "orders", rules)
        return out.select(F.lit(n).cast("long").alias("run"), "check_name", "column_name", "failures")

    table.merge(orders, ["o_orderkey"], 16)
    first = run(1)
    last_day = orders.agg(F.max("o_orderdate").alias("last"))
    late = orders.join(F.broadcast(last_day), F.col("o_orderdate") == F.col("last"), "inner").drop("last")
    table.merge(late.withColumns({"o_custkey": -F.col("o_custkey"), "o_orderstatus": F.lit("X"),
                                  "o_totalprice": -F.col("o_totalprice")}), ["o_orderkey"])
    return first.unionByName(run(2))


@register("served_order", """
SELECT l_orderkey AS order_id, l_linenumber AS line_no,
       CAST(row_number() OVER (ORDER BY l_quantity DESC, l_shipdate, l_orderkey, l_linenumber) AS BIGINT) AS place
FROM lineitem WHERE l_quantity >= 49 ORDER BY place LIMIT 500
""")
def q_served_order(spark, d):
    """The rows of a many-key order with their places, read off the order
    in which they are served."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").filter("l_quantity >= 49")
    served = ordered(lines, sort_key("l_quantity", True, False), sort_key("l_shipdate", False, False),
                     F.col("l_orderkey").asc(), F.col("l_linenumber").asc()).limit(500)
    # one partition of 500 rows, numbered as they come
    return served.coalesce(1).select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                                     (F.monotonically_increasing_id() + 1).alias("place"))


@register("served_position", """
SELECT o_orderpriority, o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,
       ROW_NUMBER() OVER (ORDER BY o_orderpriority NULLS FIRST, CAST(ROUND(o_totalprice * 100) AS BIGINT) NULLS FIRST,
                                   o_orderkey) AS position
FROM orders
""")
def q_served_position(spark, d):
    # Orders stored by range of (priority, price, key), read back with their place in the order
    orders = T(spark, d, "orders").select("o_orderpriority", "o_orderkey", cents("o_totalprice").alias("cents"))
    by, tie = ["o_orderpriority", "cents"], ["o_orderkey"]
    stored = as_table(clustered(orders, by, tie, 64), f"{checkpoint_dir(spark)}/served-{uuid.uuid4().hex}")
    return with_position(stored, by, tie)
