"""D1-D7 by change: after a merge only the touched key buckets are tested again.

A keyed ``Versioned`` table keeps its rows in buckets of the key's hash, and its
manifests tell which buckets a version changed. Failures add up over buckets
for row rules, for orphans, and for unique rules whose columns contain the key
(equal values then share a bucket). So a ledger holds the failures per rule and
bucket with the version that they were counted at; a run counts the buckets
touched since and adds up the ledger.

Orphans change with their parents as well: an untouched bucket that had orphans
is counted again. One that had none needs not, as tables merged by key never
lose a parent. Other unique rules are counted over the whole table each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.operators.quality import Relationship, Unique, UniqueCombination, _row_condition, failing
from reelmart.sources.tables import Versioned

WHOLE = -1  # the ledger's bucket of a rule that is counted over the whole table
LEDGER = ["rule", "check_name", "column_name", "bucket", "failures", "version"]


def _bucket(m: dict) -> Column:
    return F.pmod(F.xxhash64(*m["keys"]), F.lit(m["buckets"])).cast("int")


def touched_buckets(table: Versioned, since: int | None) -> set[int]:
    """Buckets of ``table`` that changed after version ``since`` (None: all)."""
    m = table.manifest()
    if since is None:
        return set(range(m["buckets"]))
    old = table._manifest(since)
    changed = {int(k) for k, f in m["folders"].items() if old["folders"].get(k) != f}
    known = {d["folder"] for d in old["deltas"]}
    new = [f"{table.path}/{d['folder']}" for d in m["deltas"] if d["folder"] not in known]
    if new:  # at most ``buckets`` numbers
        changed |= {r[0] for r in table.spark.read.parquet(*new).select(_bucket(m)).distinct().collect()}
    return changed


def _rows_of(table: Versioned, m: dict, buckets: set[int]) -> DataFrame:
    """The rows of some buckets; other folders of the base are not read."""
    rows = table.read(lambda part: int(part) in buckets).withColumn("__bucket", _bucket(m))
    return rows if len(buckets) == m["buckets"] else rows.filter(F.col("__bucket").isin(sorted(buckets)))


def _name(rule) -> str:
    return f"{rule.name}:{rule.column}->{rule.parent_column}" if isinstance(rule, Relationship) else repr(rule)


def _whole(rule, keys: Sequence[str]) -> bool:
    """Whether equal values of a unique rule can lie in several buckets."""
    own = {rule.column} if isinstance(rule, Unique) else set(getattr(rule, "columns", ()))
    return isinstance(rule, (Unique, UniqueCombination)) and not set(keys) <= own


def _counts(rows: DataFrame, rules: Sequence) -> list[DataFrame]:
    """``rule, bucket, failures`` of buckets: row rules in one pass, others one each."""
    out, fused = [], [r for r in rules if _row_condition(r) is not None]
    if fused:
        counts = rows.groupBy("__bucket").agg(*[F.count(F.when(_row_condition(r), F.lit(1))).alias(f"__c{i}")
                                                for i, r in enumerate(fused)])
        each = F.array(*[F.struct(F.lit(_name(r)).alias("rule"), F.col("__bucket").alias("bucket"),
                                  F.col(f"__c{i}").alias("failures")) for i, r in enumerate(fused)])
        out.append(counts.select(F.inline(each)))
    for r in rules:
        if isinstance(r, Relationship):
            bad = failing(rows, r)
        elif isinstance(r, (Unique, UniqueCombination)):
            cols = [r.column] if isinstance(r, Unique) else list(r.columns)
            known = rows.filter(F.col(r.column).isNotNull()) if isinstance(r, Unique) else rows
            bad = known.groupBy("__bucket", *cols).count().filter("count > 1")
        else:
            continue
        out.append(bad.groupBy(F.col("__bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("failures"))
                   .select(F.lit(_name(r)).alias("rule"), "bucket", "failures"))
    return out


def run_by_change(table: Versioned, ledger: Versioned, label: str, rules: Sequence) -> DataFrame:
    """``check_name, table_name, column_name, failures`` per rule, as ``run_checks``.

    ``ledger`` belongs to this table alone. A rule that it does not know is
    counted over all buckets. The run's counts are one commit: a run that dies
    leaves the ledger as it was, and the next one counts the same buckets.
    """
    spark, m = table.spark, table.manifest()
    if m is None or not m["keys"]:
        raise ValueError("only a table merged by key has buckets")
    before = {}  # rule -> (version, failing buckets): a row per rule
    if (known := ledger.read()) is not None:
        for r in known.groupBy("rule").agg(
                F.max("version"), F.collect_set(F.when(F.col("failures") > 0, F.col("bucket")))).collect():
            before[r[0]] = (r[1], set(r[2]))
    parts, places, changed = [], [], {}
    groups: dict[frozenset, list] = {}
    for rule in rules:
        since, bad = before.get(_name(rule), (None, set()))
        if since not in changed:
            changed[since] = touched_buckets(table, since)
        buckets = changed[since] | (bad if isinstance(rule, Relationship) else set())
        if _whole(rule, m["keys"]):
            if changed[since]:
                places.append((rule, WHOLE))
                parts.append(failing(table.read(), rule).agg(F.count(F.lit(1)).alias("failures"))
                             .select(F.lit(_name(rule)).alias("rule"), F.lit(WHOLE).alias("bucket"), "failures"))
        elif buckets:
            places += [(rule, b) for b in sorted(buckets)]
            groups.setdefault(frozenset(buckets), []).append(rule)
    for buckets, some in groups.items():
        parts += _counts(_rows_of(table, m, set(buckets)), some)
    if parts:
        counted = reduce(DataFrame.unionByName, parts)
        # a row per rule and bucket counted, also where nothing failed; at most rules x buckets
        frame = spark.createDataFrame([(_name(r), r.name, r.column, b, m["version"]) for r, b in places],
                                      "rule string, check_name string, column_name string, bucket int, version long")
        rows = frame.join(counted, ["rule", "bucket"], "left").withColumn("failures", F.coalesce("failures", F.lit(0)).cast("long"))
        ledger.merge(rows.select(*LEDGER), ["rule", "bucket"], 1)
    asked = ledger.read().filter(F.col("rule").isin([_name(r) for r in rules]))
    return asked.groupBy("rule", "check_name", "column_name").agg(F.sum("failures").alias("failures")).select(
        "check_name", F.lit(label).alias("table_name"), "column_name", "failures")
