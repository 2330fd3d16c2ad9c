"""The landed row shape shared by every table.

A landed row is ``(natural_key, raw_data, extracted_at, source_method)``,
optionally led by ``subject_id`` and ``collector_name`` and followed by
``batch_seq``, which orders batches that share an extraction time, and
``row_seq``, which orders rows of one batch that share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pulseframe.functions import paths

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("natural_key", T.StringType()),
        T.StructField("raw_data", T.VariantType()),
        T.StructField("extracted_at", T.TimestampNTZType()),
        T.StructField("source_method", T.StringType()),
    ]
)
ENVELOPE_COLUMNS = ENVELOPE_SCHEMA.fieldNames()

# Columns that may accompany the four fixed ones.
CONTEXT_COLUMNS = ["subject_id", "collector_name"]
BATCH_COLUMN, ROW_COLUMN = "batch_seq", "row_seq"
# Of a batch that was landed again after a snapshot had taken it in.
REVISION_COLUMN = "revision"
# Together these place a row in time; later rows win.
ORDER_COLUMNS = ["extracted_at", BATCH_COLUMN, REVISION_COLUMN, ROW_COLUMN]


def context_columns(df: DataFrame) -> list[str]:
    return [c for c in CONTEXT_COLUMNS if c in df.columns]


def _extraction_time(extracted_at: str | Column) -> Column:
    """One extraction time per batch, passed in so that a retry lands the same row."""
    if isinstance(extracted_at, str):
        return paths.iso_instant_to_utc_ntz(F.lit(extracted_at))
    return extracted_at.cast("timestamp_ntz")


def stage_rows(
    df: DataFrame,
    *,
    key: Column,
    payload: Column,
    source_method: str | Column,
    extracted_at: str | Column,
    batch_seq: int | Column = 0,
    row_seq: Column | None = None,
    payload_is_json: bool = False,
) -> DataFrame:
    """Build batch rows whose payload is still JSON text (``raw_text``).

    A structured payload becomes JSON; dates and timestamps turn into ISO text.
    Without ``row_seq`` a hash of the text decides between rows of one key, so
    the outcome at least never depends on task order.
    """
    text = payload if payload_is_json else F.to_json(payload)
    method = F.lit(source_method) if isinstance(source_method, str) else source_method
    seq = F.lit(batch_seq) if isinstance(batch_seq, int) else batch_seq
    return df.select(
        *context_columns(df),
        key.cast("string").alias("natural_key"),
        text.alias("raw_text"),
        _extraction_time(extracted_at).alias("extracted_at"),
        method.alias("source_method"),
        seq.cast("bigint").alias(BATCH_COLUMN),
        (F.xxhash64(text) if row_seq is None else row_seq.cast("bigint")).alias(ROW_COLUMN),
    )


def parse_rows(staged: DataFrame, strict: bool = True) -> DataFrame:
    """Turn ``raw_text`` into a VARIANT ``raw_data``.

    Strict parsing fails the batch on malformed JSON. Otherwise the bad text is
    kept in ``rejected_text`` and ``raw_data`` is NULL, so one pass serves both
    the good rows and the quarantine.
    """
    parse = F.parse_json if strict else F.try_parse_json
    raw = parse("raw_text").alias("raw_data")
    kept = [*context_columns(staged), "natural_key"]
    tail = ["extracted_at", "source_method", BATCH_COLUMN, ROW_COLUMN]
    if strict:
        return staged.select(*kept, raw, *tail)
    parsed = staged.select(*kept, raw, *tail, "raw_text")
    rejected = F.when(F.col("raw_data").isNull(), F.col("raw_text"))
    return parsed.withColumn("rejected_text", rejected).drop("raw_text")


def split_rejected(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of a leniently parsed table.

    Meant for stored rows: on an unstored frame either side repeats the parse.
    """
    bad = F.col("rejected_text").isNotNull()
    return parsed.filter(~bad).drop("rejected_text"), parsed.filter(bad).drop("raw_data")


def to_envelope(
    df: DataFrame, *, extracted_at: str | Column, batch_seq: int | Column = 0
) -> DataFrame:
    """Complete normalised rows (key, VARIANT payload, method, row_seq) to landed rows."""
    seq = F.lit(batch_seq) if isinstance(batch_seq, int) else batch_seq
    return df.select(
        *context_columns(df),
        "natural_key",
        "raw_data",
        _extraction_time(extracted_at).alias("extracted_at"),
        "source_method",
        seq.cast("bigint").alias(BATCH_COLUMN),
        ROW_COLUMN,
        *[c for c in df.columns if c == "rejected_text"],
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType = ENVELOPE_SCHEMA) -> DataFrame:
    """A Parquet table, or an empty frame of ``schema`` if it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
