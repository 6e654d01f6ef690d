import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from reelmart.config import MartConfig
from reelmart.plans import marts
from reelmart.sources import (Versioned, append_raw, append_snapshot_days, as_table, land_payloads,
                              load_new, load_raw, loaded_files, merge_fact, raw, read_seed, snapshot_table)
from reelmart.streaming import latest_version, start_fact_stream


def test_land_and_load_roundtrip(spark, scratch):
    recs = spark.createDataFrame([(1, "A", 2.5), (2, "B", None)], "id long, title string, p double")
    path = land_payloads(recs, scratch, "raw_movie_details", dt.date(2026, 3, 1))
    stamp = dt.datetime(2026, 3, 1, 6, 0)
    loaded = load_raw(spark, path, stamp, run_date=dt.date(2026, 3, 1))
    append_raw(loaded, f"{scratch}/raw")
    back = raw(spark, f"{scratch}/raw")
    assert back.count() == 2
    rows = {r.id: r for r in back.select(F.variant_get("raw_payload", "$.id", "bigint").alias("id"),
                                         F.try_variant_get("raw_payload", "$.p", "double").alias("p"),
                                         "ingested_at").collect()}
    assert rows[1].p == 2.5 and rows[2].p is None and rows[1].ingested_at == stamp


def test_read_seed_typed(spark, scratch):
    p = os.path.join(scratch, "seed.csv")
    with open(p, "w") as f:
        f.write("movie_id,snapshot_date,popularity,vote_average,vote_count,revenue\n")
        f.write("7,2026-01-01,1.5,7.25,10,2923706026\n")
    r = read_seed(spark, p).first()
    assert r.movie_id == 7 and r.snapshot_date == dt.date(2026, 1, 1) and r.revenue == 2923706026


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_as_table_may_read_what_it_replaces(spark, scratch, prefix):
    p = f"{prefix}{scratch}/a table"
    t = as_table(spark.range(3), p)
    t = as_table(t.filter("id > 0"), p)
    t = as_table(t.unionByName(t), p)
    assert sorted(r.id for r in Versioned(spark, f"{scratch}/a table").read().collect()) == [1, 1, 2, 2]


def folders(path):
    return set(os.listdir(f"{path}/data"))


def test_merge_writes_only_its_updates(spark, scratch):
    """1,000 keys merged into 10^6 rows: one small folder, none of the base's."""
    t = Versioned(spark, f"{scratch}/t")
    assert t.read() is None
    t.merge(spark.range(10 ** 6).selectExpr("id AS k", "'a' AS v"), ["k"], buckets=16)
    base, before = t.manifest(), folders(f"{scratch}/t")
    assert all(len([f for f in os.listdir(f"{scratch}/t/{x}") if f.endswith(".parquet")]) == 1
               for x in base["folders"].values()) and len(base["folders"]) == 16
    t.merge(spark.range(999_500, 1_000_500).selectExpr("id AS k", "'b' AS v"), ["k"])
    new = folders(f"{scratch}/t") - before
    assert len(new) == 1 and t.manifest()["folders"] == base["folders"]
    assert sum(os.path.getsize(f"{scratch}/t/data/{x}/{f}") for x in new for f in os.listdir(f"{scratch}/t/data/{x}")) < 50_000
    got = {r.v: (r.n, r.lo, r.hi) for r in t.read().groupBy("v").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    assert got == {"a": (999_500, 0, 999_499), "b": (1000, 999_500, 1_000_499)}
    t.compact()
    assert t.manifest()["deltas"] == [] and t.manifest()["rows"] == 1_000_500 == t.read().count()
    assert t.compact() is None


def test_compaction_rewrites_only_touched_buckets(spark, scratch):
    t = Versioned(spark, f"{scratch}/t")
    t.merge(spark.createDataFrame([(i, "a") for i in range(200)], "k long, v string"), ["k"], buckets=16)
    before = t.manifest()["folders"]
    t.merge(spark.createDataFrame([(7, "b"), (999, "c")], "k long, v string"), ["k"])
    t.merge(spark.createDataFrame([(7, "d")], "k long, v string"), ["k"])
    assert t.manifest()["folders"] == before and len(t.manifest()["deltas"]) == 2
    t.compact()
    after = t.manifest()["folders"]
    assert 1 <= sum(before.get(k) != f for k, f in after.items()) <= 2
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 201 and got[7] == "d" and got[999] == "c" and got[8] == "a"
    assert t.merge(spark.createDataFrame([], "k long, v string"), ["k"]) is None
    with pytest.raises(ValueError):
        t.merge(spark.createDataFrame([(1, "x")], "k long, v string"), ["v"])
    with pytest.raises(Exception, match="duplicate key"):
        t.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), ["k"])
    assert len(t.read().collect()) == 201


def test_deltas_are_folded_when_many_or_large(spark, scratch, monkeypatch):
    from reelmart.sources import tables
    monkeypatch.setattr(tables, "MAX_DELTAS", 2)
    t = Versioned(spark, f"{scratch}/t")
    t.merge(spark.createDataFrame([(i, 0) for i in range(100)], "k long, v int"), ["k"], buckets=4)
    sizes = []
    for n in (1, 2, 3):
        t.merge(spark.createDataFrame([(1, n), (None, n)], "k long, v int"), ["k"])
        sizes.append(len(t.manifest()["deltas"]))
    assert sizes == [1, 2, 0]
    t.merge(spark.createDataFrame([(i, 9) for i in range(90)], "k long, v int"), ["k"])
    assert t.manifest()["deltas"] == []
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 101 and got[1] == 9 and got[None] == 3 and got[95] == 0


def test_vacuum_keeps_what_recent_manifests_name(spark, scratch):
    t = Versioned(spark, f"{scratch}/t")
    for n in (1, 2, 3):
        t.replace(spark.range(n))
    os.makedirs(f"{scratch}/t/data/left-behind")
    assert t.vacuum() == 0 and len(folders(f"{scratch}/t")) == 4  # too young
    assert t.vacuum(keep=2, older_than=-60) == 2 and t.read().count() == 3
    assert t._state(t._manifest(2)).count() == 2


@pytest.mark.parametrize("left", ["nothing", "aside", "data", "both"])
def test_a_commit_that_dies_leaves_the_old_table(spark, scratch, left, monkeypatch):
    """Killed before its manifest has its name: whatever lies about, the old version is in force."""
    path = f"{scratch}/snap"
    loads = _loads(spark, range(1, 9))
    assert append_snapshot_days(spark, loads.filter("ingested_at < '2026-03-04'"), path) == 3
    def die(self, manifest):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(Versioned, "_publish", die)
        with pytest.raises(RuntimeError):
            append_snapshot_days(spark, loads, path)
    if left in ("aside", "both"):
        open(f"{path}/manifest/.half.tmp", "w").close()
    if left in ("data", "both"):
        os.makedirs(f"{path}/data/x/_temporary/0")
    assert snapshot_table(spark, path).count() == 3
    assert append_snapshot_days(spark, loads, path) == 5 and append_snapshot_days(spark, loads, path) == 0
    days = sorted(r.snapshot_date.day for r in snapshot_table(spark, path).collect())
    assert days == list(range(1, 9))
    late = snapshot_table(spark, path, since=dt.date(2026, 3, 6))
    assert sorted(r.snapshot_date.day for r in late.collect()) == [6, 7, 8]


def _loads(spark, days):
    doc = {"id": 1, "popularity": 1.0, "vote_average": 7.0, "vote_count": 10, "revenue": 5}
    return spark.createDataFrame([(json.dumps(doc), dt.datetime(2026, 3, d, 5)) for d in days],
                                 "raw_payload string, ingested_at timestamp_ntz")


def test_an_empty_first_load_makes_an_empty_table(spark, scratch):
    path = f"{scratch}/snap"
    os.makedirs(f"{path}/data/_temporary")
    assert append_snapshot_days(spark, _loads(spark, [1]).limit(0), path) == 0
    assert snapshot_table(spark, path).count() == 0
    assert append_snapshot_days(spark, _loads(spark, [1, 2]), path) == 2
    assert snapshot_table(spark, path).count() == 2


@pytest.mark.parametrize("named", [10_000, 0])
def test_landing_files_are_loaded_once(spark, scratch, named):
    landing, table = f"{scratch}/landing/x", f"{scratch}/raw"
    land = lambda i, day: land_payloads(spark.createDataFrame([(i,)], "id long"), f"{scratch}/landing", "x", day)
    load = lambda day: load_new(spark, landing, table, dt.datetime(2026, 3, day, 6), named_files=named)
    ids = lambda df: sorted(r[0] for r in df.select(F.variant_get("raw_payload", "$.id", "bigint")).collect())
    land(1, dt.date(2026, 3, 1))
    assert load(1) == 1 and load(1) == 0
    land(2, dt.date(2026, 3, 1))
    land(3, dt.date(2026, 3, 2))
    assert load(2) == 2 and load(3) == 0
    assert ids(raw(spark, table)) == [1, 2, 3] and ids(raw(spark, table, since=dt.date(2026, 3, 2))) == [2, 3]
    ledger = loaded_files(spark, table)
    assert ledger.count() == 3 == ledger.select("path").distinct().count()
    # a rewritten file is a new one
    file = next(f"{d}/{f}" for d, _, names in os.walk(landing) for f in names if f.endswith(".parquet"))
    os.utime(file, (2 ** 30, 2 ** 30))
    assert load(4) == 1


def test_a_load_that_dies_is_repeated(spark, scratch, monkeypatch):
    landing = land_payloads(spark.createDataFrame([(1,)], "id long"), scratch, "x", dt.date(2026, 3, 1))
    def die(self, manifest):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(Versioned, "_publish", die)
        with pytest.raises(RuntimeError):
            load_new(spark, landing, f"{scratch}/raw")
    assert loaded_files(spark, f"{scratch}/raw") is None
    assert load_new(spark, landing, f"{scratch}/raw") == 1 and raw(spark, f"{scratch}/raw").count() == 1


def test_old_loads_are_filtered_before_they_are_typed(spark, scratch):
    """A merge neither parses nor sorts loads that the fact has: a broken old payload is not met again."""
    stamp = lambda d: dt.datetime(2026, 3, d)
    rows = lambda *x: spark.createDataFrame(list(x), "raw_payload string, ingested_at timestamp_ntz, load_date date")
    path = f"{scratch}/fact"
    merge_fact(rows((json.dumps({"id": 1, "title": "a"}), stamp(3), stamp(3).date())), path)
    out = merge_fact(rows(("{broken", stamp(2), stamp(2).date()),
                          (json.dumps({"id": 2, "title": "b"}), stamp(4), stamp(4).date())), path)
    assert {r.movie_id: r.title for r in out.collect()} == {1: "a", 2: "b"}


def test_concurrent_commits_do_not_undo_each_other(spark, scratch):
    t = Versioned(spark, f"{scratch}/t")
    t.replace(spark.range(1))
    stale = t.manifest()
    t.replace(spark.range(2))
    with pytest.raises(Exception, match="(?i)exist"):
        t._publish(stale)
    assert t.read().count() == 2


def test_a_broken_table_is_not_an_empty_one(spark, scratch):
    t = Versioned(spark, f"{scratch}/t")
    t.merge(spark.createDataFrame([(1, "a")], "k long, v string"), ["k"])
    folder = next(iter(t.manifest()["folders"].values()))
    for f in os.listdir(f"{scratch}/t/{folder}"):
        if f.endswith(".parquet"):
            with open(f"{scratch}/t/{folder}/{f}", "wb") as out:
                out.write(b"broken")
    with pytest.raises(Exception):
        t.merge(spark.createDataFrame([(1, "b")], "k long, v string"), ["k"])
        t.read().collect()


def test_append_raw_is_partitioned_by_load_day(spark, scratch):
    recs = spark.createDataFrame([(1,)], "id long")
    path = land_payloads(recs, scratch, "x", dt.date(2026, 3, 1))
    for day in (1, 2):
        append_raw(load_raw(spark, path, dt.datetime(2026, 3, day, 6)), f"{scratch}/raw")
    assert raw(spark, f"{scratch}/raw").count() == 2
    late = raw(spark, f"{scratch}/raw", since=dt.date(2026, 3, 2))
    assert late.count() == 1 and "PartitionFilters: [isnotnull(load_date" in late._jdf.queryExecution().toString()


def test_load_time_defaults_to_now(spark, scratch):
    path = land_payloads(spark.createDataFrame([(1,)], "id long"), scratch, "x", dt.date(2026, 3, 1))
    near = load_raw(spark, path).selectExpr("abs(timestampdiff(SECOND, ingested_at, localtimestamp())) < 60 AS near")
    assert near.first().near


def test_append_snapshot_days(spark, scratch):
    day = dt.datetime(2026, 3, 1)
    doc = {"id": 1, "popularity": 1.0, "vote_average": 7.0, "vote_count": 10, "revenue": 5}
    r1 = spark.createDataFrame([(json.dumps(doc), day + dt.timedelta(hours=2))],
                               "raw_payload string, ingested_at timestamp_ntz")
    path = f"{scratch}/snap"
    assert append_snapshot_days(spark, r1, path) == 1
    assert append_snapshot_days(spark, r1, path) == 0  # same day again: nothing
    r2 = spark.createDataFrame([(json.dumps(doc), day + dt.timedelta(days=1))],
                               "raw_payload string, ingested_at timestamp_ntz")
    assert append_snapshot_days(spark, r2, path) == 1
    assert snapshot_table(spark, path).count() == 2


def _drop(spark, landing, docs, hour):
    stamp = dt.datetime(2026, 3, 1, hour)
    spark.createDataFrame([(json.dumps(d), stamp) for d in docs], "raw_payload string, ingested_at timestamp_ntz") \
        .coalesce(1).write.mode("append").parquet(landing)


def test_fact_stream(spark, scratch):
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/fact", f"{scratch}/ckpt"
    assert latest_version(spark, table) is None
    _drop(spark, landing, [{"id": 1, "title": "a", "budget": 10, "revenue": 20},
                           {"id": 2, "title": "b", "budget": 0, "revenue": 20}], 1)
    start_fact_stream(spark, landing, table, ckpt).awaitTermination()
    assert {r.movie_id: r.title for r in latest_version(spark, table).collect()} == {1: "a", 2: "b"}
    _drop(spark, landing, [{"id": 2, "title": "b2", "budget": 5, "revenue": 20}], 2)
    start_fact_stream(spark, landing, table, ckpt).awaitTermination()
    assert {r.movie_id: r.title for r in latest_version(spark, table).collect()} == {1: "a", 2: "b2"}
    # a new checkpoint folder reads everything again: nothing is lost or undone
    _drop(spark, landing, [{"id": 3, "title": "c", "budget": 5, "revenue": 20}], 3)
    start_fact_stream(spark, landing, table, f"{scratch}/ckpt2").awaitTermination()
    assert {r.movie_id: r.title for r in latest_version(spark, table).collect()} == {1: "a", 2: "b2", 3: "c"}


def test_replayed_batch_changes_nothing(spark, scratch):
    from reelmart.streaming.landing_stream import _merge_batch
    table = f"{scratch}/fact"
    run = _merge_batch(table, "stream", MartConfig())
    batch = lambda title, hour: spark.createDataFrame(
        [(json.dumps({"id": 1, "title": title}), dt.datetime(2026, 3, 1, hour))],
        "raw_payload string, ingested_at timestamp_ntz")
    run(batch("a", 1), 0)
    run(batch("b", 2), 1)
    number = Versioned(spark, table).manifest()["version"]
    run(batch("b", 2), 1)
    run(batch("a", 1), 0)
    assert Versioned(spark, table).manifest()["version"] == number
    assert latest_version(spark, table).first().title == "b"


def test_merge_fact(spark, scratch):
    def loads(rows):
        return spark.createDataFrame([(json.dumps({"id": i, "title": t}), dt.datetime(2026, 3, day))
                                      for i, t, day in rows], "raw_payload string, ingested_at timestamp_ntz")
    path = f"{scratch}/fact"
    merge_fact(loads([(1, "a", 1), (2, "b", 2)]), path)
    out = merge_fact(loads([(1, "late", 1), (2, "b2", 3), (3, "c", 3)]), path)
    assert {r.movie_id: r.title for r in out.collect()} == {1: "a", 2: "b2", 3: "c"}
    assert merge_fact(loads([(1, "late", 1), (2, "b2", 3), (3, "c", 3)]), path).count() == 3


def _shuffle_files(spark):
    from pathlib import Path
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for d in dirs for f in Path(d.getPath()).rglob("shuffle_*.data")}


def test_seed_is_gzipped_and_shuffles_of_stored_rows_go(spark, scratch):
    """what a finished write has shuffled does not stay beside its rows."""
    import time

    from reelmart.sources import read_seed, write_once, write_seed
    rows = spark.range(200).selectExpr("id AS movie_id", "date '2026-01-01' AS snapshot_date", "1.5D AS popularity",
                                       "CAST(7.25 AS DECIMAL(4,2)) AS vote_average", "id AS vote_count", "id AS revenue")
    before = _shuffle_files(spark)
    path = write_seed(rows.repartition(3, "movie_id"), f"{scratch}/seed")
    write_once(rows.repartition(3, "movie_id"), "rows")
    Versioned(spark, f"{scratch}/t").add(rows, "snapshot_date")
    end = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    import os
    assert all(f.endswith(".csv.gz") for f in os.listdir(path) if f.startswith("part-"))
    assert sorted(map(tuple, read_seed(spark, path).collect())) == sorted(map(tuple, rows.collect()))
