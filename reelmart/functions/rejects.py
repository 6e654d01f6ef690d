"""P1 with a side output: typed rows, and a table of what could not be typed.

The strict cast of ``extract`` stops a load at the first bad value and the
lenient one turns bad values into NULL without a trace. Here every payload is
read once and each is either good, with all its fields typed, or rejected, with
a reason per field. Good and rejected payloads together are the landed ones.

Reasons: ``not json`` (the payload is NULL or cannot be parsed; field NULL, the
raw value is the text), ``bad value`` (the field holds something that its type
cannot), ``missing`` (a required field is absent or a JSON null). A payload can
have several bad fields, but is rejected whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reelmart.functions.payload import FieldSpec, field_column, get_field

REJECT = "struct<field:string,raw_value:string,reason:string>"


def checked_extract(df: DataFrame, col: str, spec: Sequence[FieldSpec], keep: Iterable[str] = (),
                    required: Iterable[str] = ()) -> DataFrame:
    """``keep`` columns, ``payload_hash``, the fields of ``spec`` typed leniently,
    and ``rejects``: an array of (field, raw_value, reason), empty for a good row.

    Grain: same rows as ``df``, one pass, no shuffle. ``payload_hash`` is the
    64-bit hash of the payload's text. Column ``col`` is a JSON string or VARIANT.
    """
    required, text = set(required), F.col(col)
    unknown = required - {s.name for s in spec}
    if unknown:
        raise ValueError(f"required fields without a spec: {sorted(unknown)}")
    if isinstance(df.schema[col].dataType, StringType):
        v = F.try_parse_json(text)
    else:
        v, text = text, F.to_json(text)
    # the payload is parsed once: later expressions read the parsed column
    parsed = df.select(*[F.col(k) for k in keep], F.xxhash64(text).alias("payload_hash"),
                       text.alias("__text"), v.alias("__v"))
    v = F.col("__v")

    def reject(field, raw, reason):
        return F.struct(F.lit(field).cast("string").alias("field"), raw.cast("string").alias("raw_value"),
                        F.lit(reason).alias("reason"))

    faults = [F.when(v.isNull(), reject(None, F.col("__text"), "not json"))]
    for s in spec:
        raw = get_field(v, s.path, "string", "null")
        faults.append(F.when(raw.isNotNull() & get_field(v, s.path, s.type, "null").isNull(),
                             reject(s.name, raw, "bad value")))
        if s.name in required:
            faults.append(F.when(v.isNotNull() & raw.isNull(), reject(s.name, raw, "missing")))
    return parsed.select(*keep, "payload_hash", *[field_column(v, s, "null") for s in spec],
                         F.filter(F.array(*faults), lambda x: x.isNotNull()).cast(f"array<{REJECT}>").alias("rejects"))


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of ``checked_extract`` without a fault: ``extract``'s columns."""
    return checked.filter(F.size("rejects") == 0).drop("rejects")


def rejected(checked: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """A row per fault: ``keep``, payload_hash, field, raw_value, reason.

    Store ``checked`` (see ``sources.load_checked``) if both parts are read, or
    the payloads are read and parsed twice.
    """
    return (checked.filter(F.size("rejects") > 0)
            .select(*keep, "payload_hash", F.explode("rejects").alias("r"))
            .select(*keep, "payload_hash", "r.field", "r.raw_value", "r.reason"))
