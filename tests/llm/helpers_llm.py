"""Fixtures of the corpus operators: awkward documents, and rows as plain values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple], extra: bool = False) -> DataFrame:
    """``(doc_id, text[, lang[, source]])`` rows; ``extra`` adds columns whose names operators use inside."""
    full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("id", "g", "key", "rank", "position", "label", "shard", "word", "rows", "row", "_text", "_id", "_fold", "_key", "c", "n", "h"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    return {r[key]: r.asDict() for r in df.collect()}


AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, "  \n\t ", None, "a"),
    (4, "x", "en", "b"),
    (5, "x", "en", "b"),
    (5, "x", "en", "b"),
    (6, "émile \U0001f600 " * 30, "fr", "a"),
    (7, "long words " * 40_000, "en", "a"),
    (None, "no id here at all, just words", "en", "b"),
]
