"""P1 with rejects: every landed payload is good or rejected, with its reasons."""

import pytest
from pyspark.sql import functions as F

from reelmart.functions.payload import FieldSpec, extract
from reelmart.functions.rejects import checked_extract, good_rows, rejected
from reelmart.sources.landing import load_checked

SPEC = [FieldSpec("id", "$.id", "int"), FieldSpec("day", "$.day", "date"),
        FieldSpec("price", "$.price", "decimal(4,2)", zero_is_null=True),
        FieldSpec("name", "$.name", "string", blank_is_null=True)]
ROWS = [
    (1, '{"id": 1, "day": "2024-02-29", "price": 9.5, "name": "a"}'),
    (2, '{"id": 2, "day": "2023-02-29", "price": 123.4, "name": "a"}'),  # no such day, too large
    (3, '{"id": "x"}'),
    (4, '{"day": null, "price": null}'),  # id missing
    (5, '{"id": 5, "price": 0, "name": ""}'),  # zero and blank are NULL, not faults
    (6, '{"id": 6'),
    (7, None),
    (8, ''),
    (9, 'null'),
    (10, '{"id": 10, "name": {"en": "b"}}'),  # an object is its JSON text
    (11, '{"id": 7.6}'),
    (11, '{"id": 7.6}'),
]


@pytest.fixture()
def landed(spark):
    return spark.createDataFrame(ROWS, "k int, raw_payload string")


def test_reasons(landed):
    bad = rejected(checked_extract(landed, "raw_payload", SPEC, ["k"], ["id"]), ["k"])
    got = {(r.k, r.field, r.raw_value, r.reason) for r in bad.collect()}
    assert got == {(2, "day", "2023-02-29", "bad value"), (2, "price", "123.4", "bad value"),
                   (3, "id", "x", "bad value"), (4, "id", None, "missing"), (9, "id", None, "missing"),
                   (6, None, '{"id": 6', "not json"), (7, None, None, "not json"), (8, None, "", "not json")}


def test_good_rows_are_extracts(landed):
    checked = checked_extract(landed, "raw_payload", SPEC, ["k"], ["id"])
    good = good_rows(checked).drop("payload_hash")
    kept = landed.filter(F.col("k").isin(1, 5, 10, 11))
    strict = extract(kept, "raw_payload", SPEC, ["k"])
    assert good.columns == strict.columns
    key = lambda r: r.k
    assert sorted(good.collect(), key=key) == sorted(strict.collect(), key=key)
    assert [r.id for r in good.filter("k = 11").collect()] == [8, 8]


def test_good_and_rejected_are_all(landed):
    good, bad = load_checked(landed, "raw_payload", SPEC, ["k"], ["id"])
    assert good.count() + bad.select("k").distinct().count() == landed.count()
    by_hash = {r.k: r.payload_hash for r in landed.select("k", F.xxhash64("raw_payload").alias("payload_hash")).collect()}
    assert all(r.payload_hash == by_hash[r.k] for r in bad.collect())


def test_variant_empty_and_unknown(spark, landed):
    parsed = landed.select("k", F.try_parse_json("raw_payload").alias("raw_payload"))
    _, bad = load_checked(parsed, "raw_payload", SPEC, ["k"], ["id"])
    assert {r.k for r in bad.collect()} == {2, 3, 4, 6, 7, 8, 9}
    good, bad = load_checked(landed.limit(0), "raw_payload", SPEC)
    assert good.count() == 0 and bad.count() == 0
    with pytest.raises(ValueError):
        checked_extract(landed, "raw_payload", SPEC, required=["nope"])


def test_one_pass_without_shuffle(landed):
    plan = checked_extract(landed, "raw_payload", SPEC, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
