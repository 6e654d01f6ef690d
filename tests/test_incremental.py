import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelmart.operators.incremental import new_rows, upsert, watermark_value


def test_new_rows_strict_and_default(spark):
    # FIXTURES 4.18: a row at the old maximum, or older, is not picked up
    target = spark.createDataFrame([(1, dt.datetime(2026, 1, 5))], "k long, t timestamp_ntz")
    src = spark.createDataFrame([(1, dt.datetime(2026, 1, 5)), (2, dt.datetime(2026, 1, 4)),
                                 (3, dt.datetime(2026, 1, 6))], "k long, t timestamp_ntz")
    assert [r.k for r in new_rows(src, "t", target, dt.date(2026, 1, 1)).collect()] == [3]
    assert [r.k for r in new_rows(src, "t", target, dt.date(2026, 1, 1), literal=True).collect()] == [3]
    empty = target.limit(0)
    # an empty target uses the default start date (strict as well)
    assert sorted(r.k for r in new_rows(src, "t", empty, dt.date(2026, 1, 5)).collect()) == [3]
    assert sorted(r.k for r in new_rows(src, "t", empty, dt.date(2026, 1, 4)).collect()) == [1, 3]
    assert watermark_value(empty, "t", dt.date(2026, 1, 1)) == dt.datetime(2026, 1, 1)


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(tuple(r) for r in upsert(target, upd, ["k"]).collect()) == [
        (1, "a"), (2, "B"), (3, "C")]


def test_upsert_duplicate_key_raises(spark):
    # FIXTURES 4.25
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    upd = spark.createDataFrame([(2, "x"), (2, "y")], "k long, v string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, upd, ["k"]).collect()


def test_upsert_idempotent(spark):
    # FIXTURES 4.22 / I6: the same input twice gives the same table
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    upd = spark.createDataFrame([(2, "B")], "k long, v string")
    once = upsert(target, upd, ["k"])
    twice = upsert(once, upd, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
