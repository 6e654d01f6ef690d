"""W1 / I1 on arriving data: the newest load of each movie in keyed state.

``start_fact_stream`` compares each batch with the fact. Here Spark's keyed
state holds the newest load per movie (in the checkpoint folder), so a batch
reads its own rows and their state, neither reads nor joins the fact, and
writes the touched movies' newest rows as a delta of the versioned table.

The order of loads is the batch one: by load time, then by the payload's hash.
Late, equal and repeated loads therefore end as a batch run over all of them.
State is one typed row per movie and is never dropped, as a load of any movie
may come at any time; with many movies use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmart.config import MartConfig
from reelmart.functions.payload import extract
from reelmart.plans.marts import DETAIL_FIELDS, FACT_COLUMNS, fact_rows
from reelmart.sources.tables import Versioned
from reelmart.streaming.landing_stream import LANDING_SCHEMA

#: The fact needs no nested parts, so the state keeps none.
STATE_FIELDS = [s for s in DETAIL_FIELDS if s.type != "variant"]


def newest_loads(landed: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """The fact row of the newest load per movie; ``landed`` may be a stream.

    One keyed aggregate: a batch plan combines on the map side, a stream keeps
    it as state. Of equally new loads the smallest payload hash wins, as in
    staging; a NULL load time counts as newest where NULLs come first.
    """
    parsed = landed.select(F.parse_json("raw_payload").alias("raw_payload"), "ingested_at")
    typed = extract(parsed.withColumn("__tb", F.xxhash64(F.to_json("raw_payload"))), "raw_payload", STATE_FIELDS,
                    keep=["ingested_at", "__tb"], on_error=cfg.on_error)
    unknown = F.col("ingested_at").isNull()
    place = F.struct((unknown if cfg.desc_nulls_first else ~unknown).alias("first"), "ingested_at",
                     F.bitwise_not("__tb").alias("tie"))
    held = F.struct(*[s.name for s in STATE_FIELDS if s.name != "movie_id"], "ingested_at")
    newest = typed.groupBy("movie_id").agg(F.max_by(held, place).alias("held"))
    return fact_rows(newest.select("movie_id", "held.*")).select(*FACT_COLUMNS)


def start_newest_stream(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_location: str,
                        cfg: MartConfig = MartConfig()) -> StreamingQuery:
    """Start the landing -> fact stream on keyed state; returns the query.

    A replayed batch changes nothing (the manifest remembers the last one). The
    state belongs to the checkpoint folder: a new folder reads the landing
    folder from its start, which must then hold every load.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        Versioned(spark, table_dir).merge(batch, ["movie_id"], stream=(checkpoint_location, batch_id),
                                          check_unique=False)

    stream = newest_loads(spark.readStream.schema(LANDING_SCHEMA).parquet(landing_dir), cfg)
    return (stream.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
