"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Correctness-relevant or scale-relevant settings; cluster sizing stays with the submitter.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Wide payload rows: smaller splits keep one task's explode output in memory.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture costs a round trip per expression and doubles plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "pulseframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, "spark.ui.enabled": "false"}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach: below ``spark.checkpoint.dir``, else below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle width, for a repartitioning that must not be coalesced.

    Adaptive execution sizes partitions by bytes; payload work costs far more
    per byte than it expects.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
