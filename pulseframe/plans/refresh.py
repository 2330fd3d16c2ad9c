"""Stored models, brought up to date for what changed.

A model is stored in key buckets, one folder each. A refresh rebuilds the rows of changed keys, keeps
the others of the buckets these fall into, and overwrites those folders alone. A model can always be
built anew from the landed table, so a refresh that died half-way is repeated from the same changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulseframe.sources.envelope import read_or_empty

BUCKETS = 64


class StoredModel:
    """Rows of a model under ``path/_bucket=K``, with a bucket by hash of ``keys``.

    ``build`` makes the model's rows from landed rows; a landed row's key columns, ``landed_keys``,
    are the model's ``keys``, which may have any number of rows.
    """

    def __init__(self, path: str, keys: list[str], landed_keys: list[str], build: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS):
        self.path, self.keys, self.landed_keys, self.build, self.buckets = path.rstrip("/"), list(keys), list(landed_keys), build, buckets

    def _bucket(self, keys: list[str]):
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def refresh(self, changed: DataFrame) -> list[int]:
        """Rebuild the rows of ``changed`` landed rows; the buckets that were overwritten.

        ``changed`` is read twice, so it should be stored or cheap; its keys are one row each. Rows
        of a changed key that the model no longer has go.
        """
        spark = changed.sparkSession
        found = changed.select(self._bucket(self.landed_keys).alias("_bucket")).distinct().collect()  # a row a bucket
        touched = sorted(r[0] for r in found)
        if not touched:
            return []
        fresh = self.build(changed)
        fresh = fresh.withColumn("_bucket", self._bucket(self.keys))
        gone = changed.select(*[F.col(a).alias(b) for a, b in zip(self.landed_keys, self.keys)])
        stored = read_or_empty(spark, self.path, fresh.schema).withColumn("_bucket", F.col("_bucket").cast("int"))
        kept = stored.filter(F.col("_bucket").isin(touched)).join(gone, self.keys, "left_anti")
        rows = kept.select(*fresh.columns).unionByName(fresh).hint("rebalance", "_bucket")
        seen = Observation()
        counts = [F.count_if(F.col("_bucket") == b).alias(f"b{b}") for b in touched]
        rows.observe(seen, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)
        for b in touched:
            if not seen.get.get(f"b{b}"):  # nothing was written that could replace the folder
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_bucket={b}")
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return touched

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path).drop("_bucket")
