"""Lateral flatten of a JSON array inside a payload.

Inner semantics by default: a missing key, a JSON ``null`` and ``[]`` all
produce no rows. Runs as a narrow ``Generate`` inside one stage (no shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.functions.payload import FieldSpec, as_variant, field_column, get_field

_ELEM = "__elem"


def explode_payload(df: DataFrame, col: str, path: str, spec: Sequence[FieldSpec],
                    keep: Iterable[str] = (), outer: bool = False,
                    on_error: str = "fail") -> DataFrame:
    """One row per element of the array at ``path`` of payload ``col``.

    Grain: parent row x array element. ``keep`` columns are copied from the
    parent; ``spec`` fields are read from each element (paths like ``$.id``).
    """
    keep = list(keep)
    arr = get_field(as_variant(df, col, on_error), path, "array<variant>", on_error)
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    exploded = df.select(*[F.col(k) for k in keep], gen.alias(_ELEM))
    elem = F.col(_ELEM)
    return exploded.select(*[F.col(k) for k in keep],
                           *[field_column(elem, s, on_error) for s in spec])
