"""Typed extraction of fields from a semi-structured payload.

A payload column is either VARIANT or a JSON string (parsed on the fly).
Field specs are fixed (name, JSON path, type); nothing is inferred.

Type names follow the warehouse casts of the modelled pipeline:

``int`` / ``number``  -> DECIMAL(38,0) then BIGINT (rounds 7.6 to 8; box-office
                         numbers exceed 2^31, so never INT)
``decimal(p,s)``      -> DECIMAL(p,s) (rounds half up)
``double``/``float``  -> DOUBLE
``string``, ``boolean``, ``date``, ``timestamp_ntz``
``variant``           -> kept as VARIANT (nested parts)
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType


@dataclass(frozen=True)
class FieldSpec:
    name: str
    path: str
    type: str
    zero_is_null: bool = False
    blank_is_null: bool = False


def as_variant(df: DataFrame, col: str, on_error: str = "fail") -> Column:
    """The payload column as VARIANT (parses JSON strings)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, VariantType):
        return F.col(col)
    if isinstance(dtype, StringType):
        return F.parse_json(col) if on_error == "fail" else F.try_parse_json(col)
    raise TypeError(f"payload column {col} must be VARIANT or STRING, got {dtype}")


def get_field(v: Column, path: str, typ: str, on_error: str = "fail") -> Column:
    """One typed value out of a VARIANT; strict or lenient cast."""
    get = F.variant_get if on_error == "fail" else F.try_variant_get
    t = typ.lower().replace(" ", "")
    if t in ("int", "integer", "bigint", "long", "number"):
        # the warehouse's integer is NUMBER(38,0): a fraction rounds (7.6 -> 8)
        whole = get(v, path, "decimal(38,0)")
        return whole.cast("bigint") if on_error == "fail" else whole.try_cast("bigint")
    if t in ("float", "double"):
        return get(v, path, "double")
    if t == "variant":
        return get(v, path, "variant")
    return get(v, path, t)


def field_column(v: Column, spec: FieldSpec, on_error: str = "fail") -> Column:
    c = get_field(v, spec.path, spec.type, on_error)
    if spec.zero_is_null:
        c = F.nullif(c, F.lit(0))
    if spec.blank_is_null:
        c = F.nullif(c, F.lit(""))
    return c.alias(spec.name)


def extract(df: DataFrame, col: str, spec: Sequence[FieldSpec], keep: Iterable[str] = (),
            on_error: str = "fail") -> DataFrame:
    """Project typed fields out of payload ``col``; ``keep`` columns pass through.

    Grain: same rows as ``df``.
    """
    v = as_variant(df, col, on_error)
    return df.select(*[F.col(k) for k in keep], *[field_column(v, s, on_error) for s in spec])


def array_size(v: Column, path: str = "$") -> Column:
    """Length of the JSON array at ``path`` (NULL when absent or not an array)."""
    return F.size(F.try_variant_get(v, path, "array<variant>"))
