"""Data-quality checks D1-D7.

``failing(df, rule)`` returns the failing rows (zero rows = pass), in the
shape of the usual SQL data tests:

* row rules (not_null, accepted_range, non_negative, relationships): the
  failing rows themselves;
* unique: ``unique_field, n_records`` per duplicated value (NULLs ignored);
* unique combination: the key columns + ``n_records`` (NULLs group together);
* accepted values: ``value_field, n_records`` per unexpected value (NULL passes).

``run_checks`` evaluates many rules and returns one row per check with the
failure count. Row rules on the same table are fused into a single
aggregate pass of conditional counts; key rules cost one shuffle each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.operators.joins import orphans


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"


@dataclass(frozen=True)
class Unique:
    column: str
    name = "unique"


@dataclass(frozen=True)
class UniqueCombination:
    columns: tuple[str, ...]
    name = "unique_combination"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple
    name = "accepted_values"


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: DataFrame
    parent_column: str
    name = "relationships"


@dataclass(frozen=True)
class AcceptedRange:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    name = "accepted_range"


@dataclass(frozen=True)
class NonNegative:
    column: str
    name = "non_negative"


def _row_condition(rule) -> Column | None:
    """Failing-row predicate for row rules (NULL never fails except not_null)."""
    c = F.col(rule.column) if not isinstance(rule, UniqueCombination) else None
    if isinstance(rule, NotNull):
        return c.isNull()
    if isinstance(rule, NonNegative):
        return c < 0
    if isinstance(rule, AcceptedRange):
        ok = F.lit(True)
        if rule.min_value is not None:
            ok = ok & ((c >= rule.min_value) if rule.inclusive else (c > rule.min_value))
        if rule.max_value is not None:
            ok = ok & ((c <= rule.max_value) if rule.inclusive else (c < rule.max_value))
        return ~ok
    if isinstance(rule, AcceptedValues):
        return c.isNotNull() & ~c.isin(list(rule.values))
    return None


def failing(df: DataFrame, rule) -> DataFrame:
    """The failing rows of ``rule`` on ``df``."""
    if isinstance(rule, Unique):
        return (df.filter(F.col(rule.column).isNotNull())
                .groupBy(F.col(rule.column).alias("unique_field"))
                .agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if isinstance(rule, UniqueCombination):
        return (df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if isinstance(rule, AcceptedValues):
        return (df.filter(_row_condition(rule))
                .groupBy(F.col(rule.column).alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")))
    if isinstance(rule, Relationship):
        return orphans(df, rule.column, rule.parent, rule.parent_column).drop("__pk")
    cond = _row_condition(rule)
    if cond is None:
        raise TypeError(f"unknown rule {rule!r}")
    # a NULL condition (NULL input) never fails the test
    return df.filter(F.coalesce(cond, F.lit(False)))


def run_checks(checks: Sequence[tuple[str, DataFrame, object]]) -> DataFrame:
    """One row per check: ``check_name, table_name, column_name, failures``.

    ``checks`` holds ``(table_name, df, rule)``. Row rules of the same frame
    share one aggregate pass; unique/combination rules count duplicated
    keys; relationships count orphan rows.
    """
    parts: list[DataFrame] = []
    fused: dict[int, tuple[str, DataFrame, list]] = {}
    for table, df, rule in checks:
        if _row_condition(rule) is not None:
            fused.setdefault(id(df), (table, df, []))[2].append(rule)
        else:
            counted = failing(df, rule).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(counted.select(F.lit(rule.name).alias("check_name"),
                                        F.lit(table).alias("table_name"),
                                        F.lit(rule.column).alias("column_name"), "failures"))
    for table, df, rules in fused.values():
        counts = df.agg(*[F.count(F.when(_row_condition(r), F.lit(1))).alias(f"__c{i}")
                          for i, r in enumerate(rules)])
        rows = F.array(*[F.struct(F.lit(r.name).alias("check_name"),
                                  F.lit(table).alias("table_name"),
                                  F.lit(r.column).alias("column_name"),
                                  F.col(f"__c{i}").alias("failures"))
                         for i, r in enumerate(rules)])
        parts.append(counts.select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
