"""Fetched payloads as files.

A fetch writes one JSON document per request under folders that name the
request, e.g. ``collector_name=SLEEP/requested=2024-01-05/part.json`` or
``collector_name=STEPS/chunk_start=2024-01-01/part.json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.sources.registry import COLLECTORS, KEYED_METHODS

DAILY_FOLDERS = "collector_name string, requested date"
RANGE_FOLDERS = "collector_name string, chunk_start date"


def payload_files(
    spark: SparkSession,
    path: str,
    folders: str = DAILY_FOLDERS,
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """One row per file: the folder columns, the whole document, its method and landing time.

    ``folders`` declares the folder columns (add ``subject_id bigint`` and the
    like as needed). Folder names prune the listing; ``landed_at`` is the file's
    own time, equal on every retry.
    """
    reader = (spark.readStream if stream else spark.read).format("text").option("wholetext", "true")
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    methods = {**{c.collector_name: c.source_method for c in COLLECTORS}, **KEYED_METHODS}
    by_name = F.create_map(*[F.lit(x) for pair in methods.items() for x in pair])
    columns = [part.split()[0] for part in folders.split(",")]
    return reader.schema(f"value string, {folders}").load(path).select(
        *columns,
        F.col("value").alias("payload"),
        by_name[F.col("collector_name")].alias("source_method"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )
