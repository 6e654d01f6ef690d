"""Sources and sinks (S1-S4, S6, S7) and the safe table writers.

* S1 ``land_payloads``: records -> one-column JSON-string Parquet, partitioned
  by run date (the dated file name of a landing drop).
* S2 ``load_raw`` / ``append_raw``: landing Parquet -> VARIANT payload
  stamped with its load time (plus a 64-bit hash of the landed text, the
  dedup tiebreak) -> appended to the raw table.
* S3 ``raw``: a raw table; S4 ``read_seed``: typed CSV with a fixed schema.
* S6 ``as_view``; S7 ``as_table`` (full rebuild as a new version).
  ``load_new`` loads each landing file once: a ledger of loaded files is
  committed together with their rows.
* S8 ``merge_fact``: the movie fact merged by key; ``append_snapshot_days``:
  the daily snapshot, all new days in one commit.
* ``load_checked``: landed payloads as typed rows and a table of rejects.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, LongType, StringType, StructField,
                               StructType)

from reelmart.config import MartConfig
from reelmart.functions.payload import FieldSpec, as_variant
from reelmart.functions.rejects import checked_extract, good_rows, rejected
from reelmart.operators.incremental import watermark_value
from reelmart.sources.tables import Versioned, settings, write_once

# The typed columns of the snapshot seed CSV.
SEED_SCHEMA = StructType([
    StructField("movie_id", LongType()),
    StructField("snapshot_date", DateType()),
    StructField("popularity", DoubleType()),
    StructField("vote_average", DecimalType(4, 2)),
    StructField("vote_count", LongType()),
    StructField("revenue", LongType()),
])


def land_payloads(df: DataFrame, path: str, table: str, run_date: dt.date) -> str:
    """Write each record as one JSON string (``raw_payload``)."""
    out = f"{path.rstrip('/')}/{table}"
    (df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw_payload"))
     .withColumn("ingest_date", F.lit(run_date))
     .write.mode("append").partitionBy("ingest_date").parquet(out))
    return out


def load_raw(spark: SparkSession, path: str, ingested_at: dt.datetime | None = None,
             on_error: str = "fail", run_date: dt.date | None = None) -> DataFrame:
    """Landing Parquet -> ``raw_payload VARIANT, ingested_at TIMESTAMP_NTZ``.

    ``ingested_at`` defaults to the local time of the load; ``run_date``
    restricts the read to one landing partition (pruned at the scan).
    """
    landed = spark.read.parquet(path)
    if run_date is not None and "ingest_date" in landed.columns:
        landed = landed.filter(F.col("ingest_date") == F.lit(run_date))
    return _stamped(landed, ingested_at, on_error)


def _stamp(ingested_at: dt.datetime | None) -> Column:
    return F.lit(ingested_at).cast("timestamp_ntz") if ingested_at is not None else F.localtimestamp()


def _stamped(landed: DataFrame, ingested_at: dt.datetime | None, on_error: str) -> DataFrame:
    return landed.select(as_variant(landed, "raw_payload", on_error).alias("raw_payload"),
                         _stamp(ingested_at).alias("ingested_at"),
                         F.xxhash64("raw_payload").alias("payload_hash"))


def append_raw(raw_batch: DataFrame, table_path: str) -> None:
    """Append a loaded batch to the raw table, a folder per load day."""
    (raw_batch.withColumn("load_date", F.to_date("ingested_at"))
     .write.mode("append").partitionBy("load_date").parquet(table_path))


#: A load of up to so many new files names them to the reader; of more, it joins their names.
NAMED_FILES = 10_000


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified`` of the landing files (contents are not read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def loaded_files(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The load ledger of a raw table: ``path, length, modified, loaded_at``."""
    m = Versioned(spark, table_path).manifest()
    folders = [f"{table_path.rstrip('/')}/{f}" for k, f in (m["notes"] if m else {}).items() if k.startswith("ledger#")]
    return spark.read.parquet(*folders) if folders else None


def load_new(spark: SparkSession, landing_path: str, table_path: str, ingested_at: dt.datetime | None = None,
             on_error: str = "fail", named_files: int = NAMED_FILES) -> int:
    """Load the landing files that the raw table has not loaded yet.

    A file is known by path, length and modification time, so a repeated load
    adds nothing and a rewritten file is loaded again. Files that were loaded
    are joined away before anything is parsed; rows and ledger are one commit,
    and a load that dies is simply repeated. Returns the number of rows added.
    """
    table = Versioned(spark, table_path)
    files, known = landing_files(spark, landing_path), loaded_files(spark, table_path)
    if known is not None:
        files = files.join(known, ["path", "length", "modified"], "left_anti")
    files = write_once(files, "landing")
    n = files.count()
    if not n:
        return 0
    one_column = StructType([StructField("raw_payload", StringType())])
    if n <= named_files:
        landed = spark.read.schema(one_column).parquet(*[r.path for r in files.select("path").collect()])
    else:
        plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
        landed = spark.read.schema(one_column).option("recursiveFileLookup", True).parquet(landing_path)
        landed = landed.select("raw_payload", plain("_metadata.file_path").alias("of_file"))
        landed = landed.join(files.select(plain("path").alias("of_file")), "of_file", "left_semi").select("raw_payload")
    rows = _stamped(landed, ingested_at, on_error)
    ledger, _, _ = table._write(files.withColumn("loaded_at", _stamp(ingested_at)))
    return table.add(rows.withColumn("load_date", F.to_date("ingested_at")), "load_date",
                     {f"ledger#{ledger.rsplit('/', 1)[1]}": ledger})


def raw(spark: SparkSession, table_path: str, since: dt.date | None = None) -> DataFrame:
    """S3: a raw source table; ``since`` reads only the folders from that day on."""
    table = Versioned(spark, table_path).read(None if since is None else lambda day: day >= since.isoformat())
    if table is None:
        table = spark.read.parquet(table_path)
    return table if since is None else table.filter(F.col("load_date") >= F.lit(since))


def read_seed(spark: SparkSession, path: str, schema: StructType = SEED_SCHEMA) -> DataFrame:
    """Typed CSV seed (header row, explicit schema, no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_seed(df: DataFrame, path: str) -> str:
    """The CSV that ``read_seed`` reads, gzipped: about as many bytes as the
    table that is built from it, not several times as many."""
    with settings(df.sparkSession, CLEANUP="true"):
        df.write.option("header", True).option("compression", "gzip").csv(path)
    return path


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a (temporary) view."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, path: str) -> DataFrame:
    """Full rebuild of a table as a new version (see ``Versioned``).

    Nothing is overwritten, so ``df`` may read the table that it replaces.
    """
    table = Versioned(df.sparkSession, path)
    table.replace(df)
    return table.read()


def merge_fact(raw_details: DataFrame, path: str, cfg: MartConfig = MartConfig(), buckets: int = 64,
               stream: tuple[str, int] | None = None) -> DataFrame:
    """M11 materialised: merge the newest loads into the movie fact at ``path``.

    First build: all staged movies. Later runs: loads stamped strictly after
    the fact's newest ``ingested_at``, merged by movie. A movie's newest load is
    new exactly if any of its loads is, so older loads are filtered away before
    they are typed and deduplicated, by their day folders where the raw table
    has them. ``buckets``: about one per GB of the fact.
    """
    from reelmart.plans.marts import fact_rows, stg_movie_details
    spark = raw_details.sparkSession
    table = Versioned(spark, path)
    current = table.read()
    if current is not None:
        newest = watermark_value(current, "ingested_at", cfg.historic_start_date)
        raw_details = raw_details.filter(F.col("ingested_at") > F.lit(newest))
        if "load_date" in raw_details.columns:
            raw_details = raw_details.filter(F.col("load_date") >= F.lit(newest).cast("date"))
    rows = fact_rows(stg_movie_details(raw_details, cfg))
    table.merge(rows, ["movie_id"], buckets, stream, check_unique=False)
    return table.read()


def append_snapshot_days(spark: SparkSession, raw_details: DataFrame, table_path: str,
                         cfg: MartConfig = MartConfig(), seed: DataFrame | None = None) -> int:
    """M12 materialised: add the days after the table's newest day.

    First build (no table yet): observed + seed rows. Later runs: only days
    strictly after the newest stored day, so a second run on the same day adds
    nothing; older loads are filtered away before they are typed. The days of a
    run are one commit: a run that dies leaves the table as it was, and the next
    one adds exactly what is missing. Returns the number of rows written.
    """
    from reelmart.plans.marts import fact_movie_snapshot

    table = Versioned(spark, table_path)
    m = table.manifest()
    if m is None:
        # stored first: the shuffle by movie is gone before the one by day begins
        return table.add(write_once(fact_movie_snapshot(raw_details, None, seed, cfg), "snapshot"), "snapshot_date")
    # the manifest names the days
    days = [dt.date.fromisoformat(d) for d in {k.split("#")[0] for k in m["folders"]} if d[:4].isdigit()]
    newest = max(days, default=cfg.historic_start_date)
    newest = newest.date() if isinstance(newest, dt.datetime) else newest
    late = raw_details.filter(F.to_date("ingested_at") > F.lit(newest))
    return table.add(fact_movie_snapshot(late, None, None, cfg), "snapshot_date")


def snapshot_table(spark: SparkSession, table_path: str, since: dt.date | None = None) -> DataFrame | None:
    """The daily snapshot in force; ``since`` reads only the folders from that day on."""
    days = None if since is None else lambda day: day >= since.isoformat()
    return Versioned(spark, table_path).read(days)


def load_checked(landed: DataFrame, col: str, spec: Sequence[FieldSpec], keep: Iterable[str] = (),
                 required: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """P1 with rejects: (typed rows, faults) of landed payloads, read once.

    The payloads are typed and checked in one pass, which is written to the
    shared folder; both parts are filters of that table, so every landed payload
    is in exactly one of them (a rejected one with a row per fault).
    """
    keep = list(keep)
    checked = write_once(checked_extract(landed, col, spec, keep, required), "checked")
    return good_rows(checked), rejected(checked, keep)
