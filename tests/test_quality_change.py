"""Data tests by change equal full runs, and read only what a merge touched."""

import pytest
from pyspark.sql import functions as F

from reelmart.operators import quality
from reelmart.operators.quality_change import run_by_change, touched_buckets
from reelmart.sources.tables import Versioned

SCHEMA = "k long, g string, m double, p long"


def _rules(parent):
    return [quality.NotNull("g"), quality.NonNegative("m"), quality.AcceptedRange("m", 0, 900), quality.Unique("k"),
            quality.UniqueCombination(("k", "g")), quality.Unique("p"), quality.AcceptedValues("g", ("a", "b")),
            quality.Relationship("p", parent, "id")]


def _both(table, ledger, rules):
    """(by change, in full), comparable."""
    key = lambda r: (r.check_name, r.column_name, r.failures)
    full = quality.run_checks([("t", table.read(), r) for r in rules])
    return sorted(map(key, run_by_change(table, ledger, "t", rules).collect())), sorted(map(key, full.collect()))


@pytest.fixture()
def base(spark, scratch):
    table = Versioned(spark, f"{scratch}/t")
    i = F.col("id")
    table.merge(spark.range(1000).select(i.alias("k"), F.when(i % 10 > 0, F.lit("a")).alias("g"),
                                         (i - 5).cast("double").alias("m"), (i % 700).alias("p")), ["k"], 32)
    return table, Versioned(spark, f"{scratch}/ledger")


def test_equals_full_runs(spark, base):
    table, ledger = base
    parent = spark.range(650)
    got, want = _both(table, ledger, _rules(parent))
    assert got == want
    table.merge(spark.createDataFrame([(7, "c", -1.0, 3), (2000, None, 5.0, 9999), (8, "a", 1.0, None)], SCHEMA), ["k"])
    got, want = _both(table, ledger, _rules(parent))
    assert got == want
    table.compact()  # the same rows in new folders
    got, want = _both(table, ledger, _rules(parent))
    assert got == want
    got, want = _both(table, ledger, _rules(spark.range(10_000)))  # parents arrive, the table stays
    assert got == want and ("relationships", "p", 0) in got


def test_only_touched_buckets_are_counted(spark, base):
    table, ledger = base
    rules = [quality.NotNull("g"), quality.Unique("k")]
    run_by_change(table, ledger, "t", rules)
    first = table.manifest()["version"]
    assert ledger.read().count() == 2 * 32
    assert touched_buckets(table, first) == set()
    table.merge(spark.createDataFrame([(7, None, 1.0, 1)], SCHEMA), ["k"])
    assert len(touched_buckets(table, first)) == 1
    run_by_change(table, ledger, "t", rules)
    assert ledger.read().filter(F.col("version") > first).count() == 2
    held = ledger.manifest()["version"]
    run_by_change(table, ledger, "t", rules)
    assert ledger.manifest()["version"] == held  # nothing touched, nothing counted


def test_new_rule_and_unkeyed_table(spark, base, scratch):
    table, ledger = base
    run_by_change(table, ledger, "t", [quality.NotNull("g")])
    rules = [quality.NotNull("g"), quality.AcceptedRange("m", 0, 10)]
    got, want = _both(table, ledger, rules)
    assert got == want
    plain = Versioned(spark, f"{scratch}/plain")
    plain.replace(spark.range(3))
    with pytest.raises(ValueError):
        run_by_change(plain, ledger, "t", rules)
