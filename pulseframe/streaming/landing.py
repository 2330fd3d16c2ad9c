"""Continuous landing of payload files.

The stream's checkpoint remembers which files were landed, so it takes the
place of a date watermark for them; late or repeated payloads are settled by
the keyed upsert when the table is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulseframe.operators.upsert import LandedTable


def payload_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Landed files as a stream; ``landed_at`` is the file's own time, equal on every retry.

    All new files make one micro-batch unless ``files_per_batch`` limits it.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path).select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def without_replays(payloads: DataFrame, columns: Sequence[str], within: str = "7 days") -> DataFrame:
    """``payloads`` less those that equal one that arrived before in all ``columns``, in whatever file and micro-batch.

    What arrived is kept as state for ``within`` the time of arrival, and dropped after that; a replay that
    comes later lands once more and is settled by the keyed upsert. Time is that of the micro-batch,
    which is noted in the checkpoint: a payload about a long gone day, or in an old file, is
    never late, so none is dropped for its age.
    """
    arrived = payloads.withColumn("_arrived_at", F.current_timestamp()).withWatermark("_arrived_at", within)
    return arrived.dropDuplicatesWithinWatermark(list(columns)).drop("_arrived_at")


def land_stream(
    payloads: DataFrame,
    to_rows: Callable[[DataFrame, int], DataFrame],
    table: LandedTable,
    checkpoint: str,
    available_now: bool = True,
    writer: str | None = None,
) -> StreamingQuery:
    """Append every micro-batch of ``payloads`` to ``table`` as its own batch.

    ``to_rows(batch, batch_seq)`` builds landed rows. A replayed micro-batch has
    the same id and overwrites its own folder, so landing is exactly-once. The
    stream is a writer of its own, named after its checkpoint if not given, so
    other streams and runs on the table keep their batches.
    """
    name = writer or f"stream-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()}"

    def append(batch: DataFrame, batch_id: int) -> None:
        table.append(to_rows(batch, batch_id), batch_id, name)

    sink = payloads.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        sink = sink.trigger(availableNow=True)
    return sink.start()
