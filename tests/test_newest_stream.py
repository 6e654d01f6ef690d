"""The newest load per movie in keyed state equals a batch run over all loads."""

import datetime as dt
import json

from reelmart.plans import marts
from reelmart.sources.tables import Versioned
from reelmart.streaming import newest_loads, start_newest_stream

SCHEMA = "raw_payload string, ingested_at timestamp_ntz"


def _loads(spark, rows):
    return spark.createDataFrame(
        [(json.dumps({"id": i, "title": t, "budget": 10, "genres": [{"id": 1}]}), h and dt.datetime(2026, 3, 1, h))
         for i, t, h in rows], SCHEMA)


def _batch(spark, rows):
    return marts.fact_rows(marts.stg_movie_details(_loads(spark, rows)))


BATCHES = [
    [(1, "a", 5), (2, "b", 5), (3, "c", 5)],
    [(1, "late", 4), (2, "newer", 6)],  # a late load, a newer one
    [(3, "equal", 5), (3, "equal too", 5), (2, "newer", 6)],  # equal times, a repeated load
    [(4, "d", 7), (4, "d0", 1), (None, "nobody", 3)],
    [(1, "unstamped", None)],
]


def test_stream_equals_batch(spark, scratch):
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/fact", f"{scratch}/ckpt"
    seen = []
    for rows in BATCHES:
        seen += rows
        _loads(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        start_newest_stream(spark, landing, table, ckpt).awaitTermination()
        key = lambda r: str(r.movie_id)
        got = Versioned(spark, table).read().select(*marts.FACT_COLUMNS)
        assert sorted(got.collect(), key=key) == sorted(_batch(spark, seen).collect(), key=key)
    held = Versioned(spark, table).manifest()["version"]
    start_newest_stream(spark, landing, table, ckpt).awaitTermination()  # nothing has landed
    assert Versioned(spark, table).manifest()["version"] == held
    start_newest_stream(spark, landing, table, f"{scratch}/ckpt2").awaitTermination()  # all is read again
    assert Versioned(spark, table).read().count() == 5


def test_batch_form(spark):
    rows = [r for b in BATCHES for r in b]
    key = lambda r: str(r.movie_id)
    got = newest_loads(_loads(spark, rows))
    assert sorted(got.collect(), key=key) == sorted(_batch(spark, rows).collect(), key=key)
    assert newest_loads(_loads(spark, rows).limit(0)).count() == 0
