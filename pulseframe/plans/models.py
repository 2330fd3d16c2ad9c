"""Naming and materialising models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def import_models(refs: Sequence[DataFrame | str], aliases: Sequence[str], spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """Aliased input relations; each becomes a temp view usable from SQL.

    ``refs`` are frames or table names. An empty list, or lists of different
    lengths, is an error; named tables may omit ``aliases``.
    """
    if not refs:
        raise ValueError("import_models needs at least one relation")
    if not aliases:
        if not all(isinstance(r, str) for r in refs):
            raise ValueError("only named tables can be imported without aliases")
        aliases = [r.split(".")[-1] for r in refs]
    if len(refs) != len(aliases):
        raise ValueError("refs and aliases must be the same length")
    session = spark or SparkSession.active()
    imported = {}
    for ref, alias in zip(refs, aliases):
        frame = session.table(ref) if isinstance(ref, str) else ref
        frame.createOrReplaceTempView(alias)
        imported[alias] = frame.alias(alias)
    return imported


def materialize(
    model: DataFrame,
    name: str,
    kind: str = "view",
    path: str | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Publish a model as a lazy ``view`` or as a Parquet ``table`` at ``path``, and return it.

    A table is written to a new folder; a run never overwrites what others read.
    ``bucket_by=(count, columns)`` stores it in hash buckets: later upserts and
    joins on those columns move only the other side. Choose at least as many
    buckets as shuffle partitions, or Spark prefers to move both.
    """
    if kind == "view":
        model.createOrReplaceTempView(name)
        return model
    if kind != "table":
        raise ValueError(f"unknown materialization {kind!r}")
    if path is None:
        raise ValueError("a table needs a path")
    spark = model.sparkSession
    if bucket_by is not None:
        count, columns = bucket_by
        # One task per bucket, so a bucket is one file.
        placed = model.repartition(count, *columns)
        writer = placed.write.bucketBy(count, *columns).sortBy(*columns).mode("errorifexists")
        writer.option("path", path).saveAsTable(name)
        return spark.table(name)
    model.write.mode("errorifexists").parquet(path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
