"""Extraction high-water marks and the fetch plan they imply."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.dates import day_sequence
from pulseframe.operators.upsert import latest_by_key, upsert
from pulseframe.session import shuffle_partitions
from pulseframe.sources.envelope import read_or_empty
from pulseframe.sources.registry import with_collectors

# Operating limits of the fetch.
DEFAULT_LOOKBACK_DAYS = 30
REFETCH_BUFFER_DAYS = 3
MAX_RANGE_DAYS = 27

STATE_SCHEMA = "collector_name string, last_extracted_date date, updated_at timestamp_ntz"


def _date(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def fetch_windows(
    subjects: DataFrame,
    state: DataFrame,
    today: str | Column,
    since: str | None = None,
    only: str | Iterable[str] | None = None,
) -> DataFrame:
    """``[start_date, end_date]`` to fetch, per subject and collector, for all collectors at once.

    The window re-opens three days behind the last run so late-finalised days
    are fetched again, and looks back 30 days when there was no run. ``since``
    replaces the watermark for this run. ``state`` shares the subject columns.
    """
    keys = [*subjects.columns, "collector_name"]
    run = _date(today)
    start = F.coalesce(
        F.date_sub("last_extracted_date", REFETCH_BUFFER_DAYS),
        F.date_sub(run, DEFAULT_LOOKBACK_DAYS),
    )
    if since is not None:
        start = F.lit(since).cast("date")
    return (
        with_collectors(subjects, only)
        .join(state.select(*keys, "last_extracted_date"), keys, "left")
        .select(*keys, "source_method", "kind", start.alias("start_date"), run.alias("end_date"))
    )


def daily_requests(windows: DataFrame) -> DataFrame:
    """One row per day of every daily collector's window, both ends included.

    A window is a few bytes and its days are many rows, so windows are spread by their number first:
    adaptive execution, which merges by bytes, would give them all to one task.
    """
    days = day_sequence(F.col("start_date"), F.col("end_date"))
    return (
        windows.filter(F.col("kind") == "daily")
        .repartition(shuffle_partitions(windows.sparkSession))
        .withColumn("requested", F.explode(days))
        .drop("kind", "start_date", "end_date")
    )


def chunk_ranges(
    windows: DataFrame, start: str = "start_date", end: str = "end_date", max_days: int = MAX_RANGE_DAYS
) -> DataFrame:
    """Split each window into inclusive chunks of at most ``max_days`` days."""
    chunk_end = F.least(F.date_add("chunk_start", max_days - 1), F.col("_end"))
    return (
        windows.withColumn("_end", F.col(end))
        .withColumn("chunk_start", F.explode(day_sequence(F.col(start), F.col(end), max_days)))
        .withColumn("chunk_end", chunk_end)
        .drop("_end", start, end)
    )


def range_requests(windows: DataFrame) -> DataFrame:
    """One row per chunk of every range collector's window."""
    return chunk_ranges(windows.filter(F.col("kind") == "range")).drop("kind")


def _marks(ran: DataFrame, keys: list[str], run_date: str | Column, updated_at: Column) -> DataFrame:
    return ran.select(
        *keys,
        _date(run_date).alias("last_extracted_date"),
        updated_at.cast("timestamp_ntz").alias("updated_at"),
    )


def advance(state: DataFrame, ran: DataFrame, run_date: str | Column, updated_at: Column) -> DataFrame:
    """State after a run: every collector that ran is set to the run date.

    The mark follows the run even when nothing was fetched, and may move back.
    """
    keys = [c for c in state.columns if c not in ("last_extracted_date", "updated_at")]
    marks = _marks(ran, keys, run_date, updated_at)
    return upsert(state, marks, keys, order=["updated_at", "last_extracted_date"])


class StateLog:
    """Stored watermarks: a folder of marks per run and collector, the newest run of a collector counts."""

    def __init__(self, spark: SparkSession, path: str, subject: str | None = None):
        """``subject`` declares the subject column, e.g. ``"subject_id bigint"``."""
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = ", ".join([*([subject] if subject else []), STATE_SCHEMA, "run_seq bigint"])
        self.keys = [*([subject.split()[0]] if subject else []), "collector_name"]

    def append(self, ran: DataFrame, run_date: str | Column, updated_at: Column, run_seq: int) -> None:
        """Advance the collectors in ``ran``; a retried run replaces their marks, and no others of its number."""
        marks = _marks(ran, self.keys, run_date, updated_at)
        writer = marks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collector_name")
        writer.parquet(f"{self.path}/run_seq={int(run_seq)}")

    def current(self, before: int | None = None) -> DataFrame:
        """Newest marks; a run plans from those ``before`` its own number, so that it can be repeated."""
        empty = self.spark.createDataFrame([], self.schema).schema
        stored = read_or_empty(self.spark, self.path, empty)
        if before is not None:
            stored = stored.filter(F.col("run_seq") < before)
        return latest_by_key(stored, self.keys, ["run_seq"]).select(*[c for c in empty.names if c != "run_seq"])
