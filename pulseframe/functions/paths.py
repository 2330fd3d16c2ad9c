"""Typed extraction from VARIANT payloads.

Every helper takes a VARIANT column and a JSON path and returns a column that
stays inside code generation. On Parquet these paths are pushed into the scan,
so a projection reads only the sub-columns it names.

Casts are strict: a value that cannot be converted raises, and a missing path
or JSON null gives SQL NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def as_string(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "string")


def as_int(v: Column, path: str) -> Column:
    """Integer cast that rounds half away from zero (71.5 -> 72, "12.6" -> 13).

    A direct ``int`` extraction would truncate and reject fractional text.
    """
    return F.variant_get(v, path, "decimal(38,0)").cast("bigint")


def as_float(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "double")


def as_boolean(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "boolean")


def as_date(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "date")


def as_local_timestamp(v: Column, path: str, zone: str | None = None) -> Column:
    """Zone-less local text read as an instant, in ``zone`` or the session zone."""
    if zone is None:
        return F.variant_get(v, path, "timestamp")
    wall_clock = F.variant_get(v, path, "timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), wall_clock).cast("timestamp")


def as_variant(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant")


def epoch_ms_to_ntz(v: Column, path: str) -> Column:
    """Epoch milliseconds that already are local wall-clock time: no zone shift."""
    return ms_to_ntz(as_int(v, path))


def ms_to_ntz(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def ntz_to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a naive timestamp taken as UTC, whatever the session zone is."""
    return F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp"))


def round_to_long(x: Column) -> Column:
    """A double rounded half away from zero.

    Plain arithmetic stays in generated code; ``round`` on doubles goes through
    arbitrary-precision decimals and takes about eight times as long.
    """
    return F.when(x >= 0, F.floor(x + 0.5)).otherwise(F.ceil(x - 0.5))


def ms_to_instant(ms: Column) -> Column:
    """Epoch milliseconds (possibly a double) to an instant."""
    return F.timestamp_millis(round_to_long(ms))


def instant_to_utc_ntz(ts: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz"))


def iso_instant_to_utc_ntz(text: Column) -> Column:
    """ISO text with an offset to a UTC ``TIMESTAMP_NTZ``."""
    return instant_to_utc_ntz(F.to_timestamp(text))


def items(v: Column, path: str = "$") -> Column:
    """Array elements at ``path``; NULL when the value is not an array."""
    return F.try_variant_get(v, path, "array<variant>")


def array_size(v: Column, path: str = "$") -> Column:
    """Element count; NULL for anything but an array, 0 for an empty one.

    Elements are read as booleans, which most are not: they come out NULL, still
    count, and their contents stay undecoded.
    """
    return F.array_size(F.try_variant_get(v, path, "array<boolean>")).cast("bigint")


# JSON texts that count as "nothing returned".
FALSY_JSON = r'^\s*(\{\s*\}|\[\s*\]|null|false|""|-?0+(\.0*)?([eE][+-]?\d+)?)?\s*$'


def is_truthy_json(text: Column) -> Column:
    """False for NULL, blank, ``null``, ``false``, zero, and empty text, array or object.

    The pattern is anchored, so a large payload is rejected at its first characters.
    """
    return F.coalesce(~text.rlike(FALSY_JSON), F.lit(False))


def truthy_text(v: Column, path: str) -> Column:
    """Text of the value at ``path`` when it is non-empty, else NULL.

    Type decides emptiness: the text ``"0"`` counts as a value, the number 0 does not.
    """
    value = F.try_variant_get(v, path, "variant")
    text = F.try_variant_get(v, path, "string")
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))  # a field that is missing is looked up once
        .when(kind == "STRING", F.when(text != "", text))
        .when(kind == "BOOLEAN", F.when(F.try_variant_get(v, path, "boolean"), F.lit("True")))
        .when(kind.rlike("^(OBJECT|ARRAY)<"), F.when(~text.isin("{}", "[]"), text))
        .otherwise(F.when(F.try_variant_get(v, path, "double") != 0, text))
    )
