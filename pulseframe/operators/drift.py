"""Payload drift: the shapes that landed payloads have, against what staging reads."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shapes of a payload's values, by the type a merged schema gives them.
_SHAPES = {
    T.StringType: "string",
    T.BooleanType: "boolean",
    T.LongType: "number",
    T.DoubleType: "number",
    T.FloatType: "number",
    T.DecimalType: "number",
    T.StructType: "object",
    T.ArrayType: "array",
    T.NullType: "null",
    T.VariantType: "mixed",
}
# The shape that a staged kind is read from without a conversion.
EXPECTED = {
    "string": "string",
    "int": "number",
    "float": "number",
    "boolean": "boolean",
    "date": "string",
    "local_timestamp": "string",
    "epoch_ms": "number",
    "array_size": "array",
    "variant": None,
}
FINDINGS = "unknown", "changed", "missing"


def payload_shapes(landed: DataFrame, by: str = "collector_name") -> DataFrame:
    """One merged schema per collector: an aggregate that each task reduces to a row before the shuffle."""
    return landed.groupBy(by).agg(F.schema_of_variant_agg("raw_data").alias("shape"))


def paths_of(kind: T.DataType, path: str = "$") -> dict[str, str]:
    """Every path in a merged schema with its shape; elements of an array are ``[*]``."""
    out = {path: _SHAPES.get(type(kind), kind.simpleString())}
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            out |= paths_of(f.dataType, f"{path}.{f.name}")
    if isinstance(kind, T.ArrayType):
        out |= paths_of(kind.elementType, f"{path}[*]")
    return out


def drift_of(shape: str, specs: Iterable[tuple[str, str]]) -> list[tuple[str, str, str | None, str | None]]:
    """``(path, finding, expected, found)`` of one collector's merged schema against ``(path, kind)`` specs.

    A path is unknown if nothing reads it, anything below or any list around it, and only the topmost such path is
    named; changed if its values have another shape than the kind is read from, mixed ones included;
    missing if no payload has it. Values that are always null change nothing.
    """
    found = paths_of(T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", shape)))
    read: dict[str, str] = {}
    whole = set()  # read with all that is in them
    for path, kind in specs:
        if kind in EXPECTED:
            place = re.sub(r"\[\d+\]", "[*]", path)
            read.setdefault(place, kind)
            whole |= {place} if kind == "variant" else set()
    out = []
    for path, kind in read.items():
        expected = EXPECTED[kind]
        if path not in found:
            out.append((path, "missing", expected, None))
        elif expected and found[path] not in (expected, "null"):
            out.append((path, "changed", expected, found[path]))
    inner = {p for path in read for p in _above(path)}
    named: set[str] = set()
    for path in sorted(found, key=len):
        above = _above(path)
        if found[path] == "null" or path in inner or path in read or above & (whole | named):
            continue
        named.add(path)
        out.append((path, "unknown", None, found[path]))
    return sorted(out)


def _above(path: str) -> set[str]:
    """The paths that hold ``path``."""
    cuts = [m.start() for m in re.finditer(r"\.|\[\*\]", path)]
    return {path[:i] for i in cuts}


def payload_drift(landed: DataFrame, specs: Mapping[str, Iterable[tuple[str, str]]], by: str = "collector_name") -> DataFrame:
    """``collector_name, path, finding, expected, found`` for every collector with specs.

    The payloads are reduced to one schema text a collector where they are; these few texts are
    compared with the specs in the driver. Rows without a payload count for nothing.
    """
    spark = landed.sparkSession
    shapes = payload_shapes(landed.filter(F.col(by).isin(list(specs)) & F.col("raw_data").isNotNull()), by).collect()  # a row a collector
    found = [(r[by], *x) for r in shapes for x in drift_of(r["shape"], specs[r[by]])]
    return spark.createDataFrame(found, f"{by} string, path string, finding string, expected string, found string")
