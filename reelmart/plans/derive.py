"""Movie-style raw payload tables derived by Spark from the TPC-H-like tables.

The mart pipeline consumes semi-structured payloads (one JSON document per
movie per load). The supplied tables hold no movies, so this adapter maps
them onto that shape; every payload grows with the tables:

* movie = an order, whatever its size; release date = order date; revenue =
  total price in cents; budget = sum of line prices in cents (0 when the order
  has no lines, so it reads as unknown); popularity = total / 1000; votes = sum
  of line quantities; rating = 100 x the largest line discount; runtime = lines.
* An order's lines are first summed by cell, its (part brand, supplier nation)
  pairs. The schema has 25 brands and 25 nations, so an order of any number of
  lines has at most 625 cells, and no list is longer. A hot order is summed on
  the map side and meets as cells only.
* genres = nations of the cells; production companies = brands of the cells;
  collection = the order's priority class, for orders of customers whose key
  is even.
* cast = one member per cell (person = brand and nation, billing order = lowest
  line number, popularity = largest quantity / 10), so larger orders list more
  than the ten members that the marts keep; crew = the order's customer, whose
  job depends on the market segment ('Director' in three spellings, or other).
* payloads are VARIANT objects built directly from structs
  (``to_variant_object``); the JSON-string landing path (S1/S2) is covered by
  ``payload_explode``, ``source_round_trip`` and the source tests.
* loads: every order is loaded one hour after its order date; open orders
  ('O') are re-loaded six hours later the same day and again the next day
  with higher popularity and votes (exercises dedup and daily snapshots).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _t(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of the stored orders and lines that one part of the orders stands for.
PART_BYTES = 4 << 20
#: Slices of the lines of a cell that are summed apart in many parts.
SLICES = 8


def order_parts(spark, sf_dir: str) -> int:
    """Parts that the orders are dealt into: more of them the larger the tables,
    so that what a task holds does not grow."""
    size = 0
    for name in ("orders", "lineitem"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return -(-size // PART_BYTES)


def order_cells(spark, sf_dir: str) -> DataFrame:
    """Lines summed by (order, brand, nation)."""
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = (_t(spark, sf_dir, "lineitem")
             .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
             .join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
             .join(part, F.col("l_partkey") == F.col("p_partkey")))
    keys = ["l_orderkey", "p_brand", "n_nationkey", "n_name"]
    sums = lines.select(*keys, F.lit(1).cast("bigint").alias("lines"),
                        F.round(F.col("l_extendedprice") * F.lit(100.0)).cast("bigint").alias("cents"),
                        F.col("l_quantity").alias("quantity"), F.col("l_quantity").alias("most"),
                        F.col("l_discount").alias("discount"), F.col("l_linenumber").cast("bigint").alias("first_line"),
                        F.pmod(F.xxhash64("l_linenumber", "l_partkey", "l_suppkey"), F.lit(SLICES)).alias("slice"))

    def summed(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(
            F.sum("lines").alias("lines"), F.sum("cents").alias("cents"), F.sum("quantity").alias("quantity"),
            F.max("most").alias("most"), F.max("discount").alias("discount"), F.min("first_line").alias("first_line"))

    parts = order_parts(spark, sf_dir)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        # slices of a cell are summed first, so that a hot order meets as few rows of each cell
        sums = summed(sums.repartition(parts, *keys, "slice"), *keys, "slice").repartition(parts, "l_orderkey")
    return summed(sums, *keys)


#: What the cast needs of a cell, and what tells cells apart.
CAST_CELL = ("p_brand", "n_nationkey", "n_name", "first_line", "most")
LIST_CELL = CAST_CELL[:3]


def cell_lists(cells: DataFrame, fields: tuple[str, ...] = CAST_CELL) -> DataFrame:
    """One row per order with lines: its sums, and its cells (at most 625) as a list."""
    return cells.groupBy("l_orderkey").agg(
        F.sum("lines").alias("runtime"), F.sum("cents").alias("budget"),
        F.sum("quantity").cast("bigint").alias("votes"), F.max("discount").alias("discount"),
        F.collect_list(F.struct(*fields)).alias("cells"))


def brand_no(brand) -> F.Column:
    return F.substring_index(brand, "#", -1).cast("bigint")


def _movies(spark, sf_dir: str, cells: DataFrame | None, lists: DataFrame | None) -> DataFrame:
    """One row per order with its sums and bounded, sorted lists."""
    def company(cell):
        no = brand_no(cell["p_brand"])
        return F.struct(no.alias("id"), cell["p_brand"].alias("name"),
                        F.when(no < 5, F.lit("")).otherwise(F.lit("US")).alias("origin_country"))

    def genre(cell):
        return F.struct(cell["n_nationkey"].cast("bigint").alias("id"), cell["n_name"].alias("name"))

    # only what tells cells apart travels; the lists are built from it behind the shuffle
    listed = lambda element: F.array_sort(F.array_distinct(F.transform("cells", element)))
    if lists is None:
        lists = cell_lists(order_cells(spark, sf_dir) if cells is None else cells, LIST_CELL)
    agg = lists.select(
        "l_orderkey", "runtime", "budget", "votes", "discount", listed(genre).alias("genres"),
        listed(company).alias("production_companies"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return (_t(spark, sf_dir, "orders").join(agg, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                    none("runtime"), none("budget"), none("votes"),
                    F.round(F.col("discount") * F.lit(100.0), 2).alias("vote_average"),
                    F.coalesce("genres", F.array()).alias("genres"),
                    F.coalesce("production_companies", F.array()).alias("production_companies")))


# Load schedule of the derived payloads (hours after the
# order date, popularity factor, extra votes); the later loads apply to
# open orders only.
LOADS = [(1, 1.0, 0, False), (7, 1.5, 10, True), (25, 2.0, 20, True)]


def _stamped(hours) -> F.Column:
    return (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)).cast("timestamp_ntz").alias("ingested_at")


def raw_movie_details(spark, sf_dir: str, cells: DataFrame | None = None,
                      lists: DataFrame | None = None) -> DataFrame:
    """Raw table (raw_payload VARIANT, ingested_at TIMESTAMP_NTZ).

    ``lists``: the ``cell_lists`` of the orders, where they are stored.

    The loads are generated in one pass (``explode`` over the fixed load
    schedule), so the line aggregation is computed once.
    """
    schedule = F.array(*[F.struct(F.lit(h).alias("hours"), F.lit(f).alias("factor"),
                                  F.lit(e).alias("extra"), F.lit(o).alias("open_only"))
                         for h, f, e, o in LOADS])
    m = (_movies(spark, sf_dir, cells, lists).select("*", F.explode(schedule).alias("__load"))
         .filter(~F.col("__load.open_only") | (F.col("o_orderstatus") == "O")))
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("Released"))
              .when(F.col("o_orderstatus") == "O", F.lit("Post Production"))
              .otherwise(F.lit("In Production")))
    key = F.col("o_orderkey").cast("string")
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Title "), key).alias("title"),
        F.concat(F.lit("Original "), key).alias("original_title"),
        F.lower("o_orderstatus").alias("original_language"),
        status.alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        F.col("runtime"),
        F.col("budget"),
        F.round(F.col("o_totalprice") * F.lit(100.0)).cast("bigint").alias("revenue"),
        F.col("vote_average"),
        (F.col("votes") + F.col("__load.extra")).alias("vote_count"),
        (F.col("o_totalprice") / F.lit(1000.0) * F.col("__load.factor")).alias("popularity"),
        F.concat(F.lit("Ordered with priority "), F.col("o_orderpriority")).alias("overview"),
        F.lit(False).alias("video"),
        (F.col("o_orderpriority") == F.lit("1-URGENT")).alias("adult"),
        F.concat(F.lit("tt"), key).alias("imdb_id"),
        F.when(F.col("o_custkey") % 2 == 0, F.struct(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id"),
            F.col("o_orderpriority").alias("name"))).alias("belongs_to_collection"),
        F.col("genres"), F.col("production_companies"))
    return m.select(F.to_variant_object(doc).alias("raw_payload"), _stamped(F.col("__load.hours")),
                    F.xxhash64(doc).alias("payload_hash"))


def raw_credits(spark, sf_dir: str, cells: DataFrame | None = None,
                lists: DataFrame | None = None) -> DataFrame:
    """Raw credits table: cast = the order's cells, crew = its customer."""
    def member(cell):
        person = brand_no(cell["p_brand"]) * 1000 + cell["n_nationkey"]
        return F.struct(
            person.cast("bigint").alias("id"), F.concat_ws(" of ", cell["p_brand"], cell["n_name"]).alias("name"),
            F.concat(F.lit("Line "), cell["first_line"].cast("string")).alias("character"),
            cell["first_line"].alias("order"),
            F.lit(False).alias("adult"),
            F.pmod(cell["n_nationkey"], F.lit(3)).cast("bigint").alias("gender"),
            F.lit("Acting").alias("known_for_department"),
            (cell["most"] / F.lit(10.0)).alias("popularity"),
            F.concat_ws("-", "l_orderkey", person.cast("string")).alias("credit_id"),
            F.lit("Acting").alias("department"), F.lit("Actor").alias("job"))

    if lists is None:
        lists = cell_lists(order_cells(spark, sf_dir) if cells is None else cells)
    # at most 625 cells; their members are built behind the shuffle
    cast = lists.select("l_orderkey", "cells")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                 "c_acctbal", "c_mktsegment")
    job = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Director"))
           .when(F.col("c_mktsegment") == "MACHINERY", F.lit("DIRECTOR"))
           .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("director"))
           .when(F.col("c_mktsegment") == "FURNITURE", F.lit("Producer"))
           .otherwise(F.lit("Writer")))
    crew_member = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), job.alias("job"),
        F.lit("Directing").alias("department"), F.lit("Directing").alias("known_for_department"),
        (F.col("c_acctbal") / F.lit(1000.0)).alias("popularity"),
        F.pmod(F.col("c_nationkey"), F.lit(3)).cast("bigint").alias("gender"))
    # orders meet their customers first: the lists are not dealt by customer
    j = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")
         .select("o_orderkey", "o_orderdate", crew_member.alias("crew_member"))
         .join(cast, F.col("l_orderkey") == F.col("o_orderkey"), "inner"))
    doc = F.struct(F.col("o_orderkey").alias("id"), F.array_sort(F.transform("cells", member)).alias("cast"),
                   F.array("crew_member").alias("crew"))
    return j.select(F.to_variant_object(doc).alias("raw_payload"), _stamped(F.lit(1)),
                    F.xxhash64(doc).alias("payload_hash"))
