"""Fetched payloads to landed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.sources.envelope import ROW_COLUMN, context_columns

# Payload fields that may carry a row's calendar date, best first.
DATE_KEY_FIELDS = ("calendarDate", "date", "summaryDate")


def row_key(item: Column, fallback: Column) -> Column:
    """First non-empty date field of an object payload, else ``fallback``."""
    return F.coalesce(*[paths.truthy_text(item, f"$.{f}") for f in DATE_KEY_FIELDS], fallback)


def _parsed(payloads: DataFrame, strict: bool) -> tuple[DataFrame, list[str]]:
    """Non-empty payloads with a VARIANT ``body``; the extra columns rows must carry.

    Lenient parsing leaves ``body`` NULL and the text in ``rejected_text``, so a
    bad payload costs its own row and not the run.
    """
    parse = F.parse_json if strict else F.try_parse_json
    parsed = payloads.filter(paths.is_truthy_json(F.col("payload"))).withColumn("body", parse("payload"))
    if strict:
        return parsed, []
    rejected = F.when(F.col("body").isNull(), F.col("payload"))
    return parsed.withColumn("rejected_text", rejected), ["rejected_text"]


def explode_range_items(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """One row per item of each range payload, with its position in the payload.

    ``payloads`` has ``chunk_start`` (date), ``payload`` (JSON text) and
    ``source_method``. An empty payload gives no row, an object one, an array
    one per element. Narrow: nothing is shuffled.
    """
    parsed, extra = _parsed(payloads, strict)
    # An object is a one-item list.
    listed = F.coalesce(paths.items(F.col("body")), F.array("body"))
    return parsed.select(
        *context_columns(payloads),
        "chunk_start",
        "source_method",
        *extra,
        F.posexplode(listed).alias("position", "item"),
    )


def normalize_range(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """Range payloads to keyed rows; undated items are keyed ``{chunk_start}_{position}``.

    Positions restart with every payload, so the fallback key is unique per
    chunk but moves when the chunk grid moves.
    """
    exploded = explode_range_items(payloads, strict)
    fallback = F.concat_ws("_", F.col("chunk_start").cast("string"), F.col("position"))
    return exploded.select(
        *context_columns(payloads),
        row_key(F.col("item"), fallback).alias("natural_key"),
        F.col("item").alias("raw_data"),
        "source_method",
        # Later chunks, then later positions, win within a batch.
        (F.shiftleft(F.unix_date("chunk_start").cast("bigint"), 32) + F.col("position")).alias(ROW_COLUMN),
        *[c for c in exploded.columns if c == "rejected_text"],
    )


def normalize_keyed(payloads: DataFrame, key: Column, strict: bool = True) -> DataFrame:
    """One row per non-empty payload under a key known before the fetch; lists are kept whole."""
    parsed, extra = _parsed(payloads, strict)
    return parsed.select(
        *context_columns(payloads),
        key.cast("string").alias("natural_key"),
        F.col("body").alias("raw_data"),
        "source_method",
        F.xxhash64("payload").alias(ROW_COLUMN),
        *extra,
    )


def normalize_daily(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """Daily payloads to rows keyed by the *requested* day, whatever the payload says."""
    return normalize_keyed(payloads, F.col("requested"), strict)
