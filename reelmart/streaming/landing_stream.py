"""Structured Streaming form of the daily load (optional path).

Landing folder (one-column JSON-string Parquet files, with the time of their
load) -> file stream -> ``foreachBatch``: parse, latest load per movie
(row-number windows are batch-only, so they run inside ``foreachBatch``), and
merge into the versioned fact by key.

The table's manifest remembers the last batch of each stream (by checkpoint
folder), so a replayed batch changes nothing, and a stream with a new
checkpoint folder goes on from the version in force. Load times come from the
landed rows, not from the clock, so a replay stamps the same. A movie's row is
replaced only by a newer load. ``trigger(availableNow=True)`` processes what
has landed and stops, which matches a daily schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from reelmart.config import MartConfig
from reelmart.plans.marts import FACT_COLUMNS, fact_rows, stg_movie_details
from reelmart.sources.tables import Versioned

LANDING_SCHEMA = StructType([StructField("raw_payload", StringType()),
                             StructField("ingested_at", TimestampNTZType())])


def latest_version(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The fact in force, or None if it was never written. Errors are raised."""
    return Versioned(spark, table_dir).read()


def _merge_batch(table_dir: str, stream_id: str, cfg: MartConfig):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = Versioned(spark, table_dir)
        raw = batch.select(F.parse_json("raw_payload").alias("raw_payload"), "ingested_at")
        rows = fact_rows(stg_movie_details(raw, cfg)).select(*FACT_COLUMNS)
        current = table.read()
        if current is not None:  # keep what is as new as the batch
            held = current.select("movie_id", F.col("ingested_at").alias("__held"))
            rows = (rows.join(held, "movie_id", "left")
                    .filter(F.col("__held").isNull() | (F.col("ingested_at") > F.col("__held"))).drop("__held"))
        table.merge(rows, ["movie_id"], stream=(stream_id, batch_id), check_unique=False)
    return run


def start_fact_stream(spark: SparkSession, landing_dir: str, table_dir: str,
                      checkpoint_location: str, cfg: MartConfig = MartConfig()) -> StreamingQuery:
    """Start the landing -> fact stream; returns the query (call
    ``awaitTermination`` / ``processAllAvailable``)."""
    stream = spark.readStream.schema(LANDING_SCHEMA).parquet(landing_dir)
    return (stream.writeStream.foreachBatch(_merge_batch(table_dir, checkpoint_location, cfg))
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
