"""Shared folder, total ranks and connected components for the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# monotonically_increasing_id() keeps the row's place in its partition below this bit.
_PLACE_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach: below ``spark.checkpoint.dir``, else below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a written table: lineage ends here and a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the folder of a table that ``store`` returned and that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.stored_in)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs meanwhile hands Python batches of about ``size`` bytes, of one row at least, instead of 10,000 rows.

    An executor keeps buffers outside its heap as large as the batches that went through them.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) decided by the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def ranked(df: DataFrame, order: Sequence[Column], purpose: str) -> DataFrame:
    """``df`` with ``rank``, each row's 0-based place in the total order.

    Rows are sorted into ranges, every range numbers its own rows, and the ranges' row counts (one
    row per partition) give the offsets: no window over all rows. End the order with a unique column
    and a value shared by a third of all rows is still cut into many ranges.
    """
    cells = store(
        df.repartitionByRange(width(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        purpose,
    )
    part = F.shiftright("_place", _PLACE_BITS)
    counts = cells.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        cells.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn("rank", F.col("_offset") + place)
        .drop("_part", "_offset", "_place")
    )


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of long ids to ``(id, component)``, the smallest id that links reach.

    Every round takes the smallest label among a node's neighbours and then the label of that label
    until nothing changes; each round is a stored table. Ids without an edge are not in the result.
    """
    sides = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").toDF("a", "b").distinct()
    sides = store(sides, "edges")
    labels = store(sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    while True:
        now = labels.select("id", "component")
        near = (
            sides.join(now.toDF("b", "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        closer = now.join(near, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        root = now.toDF("component", "root")
        moved = store(
            closer.join(root, "component").select("id", F.least("component", "root").alias("component"), "was"),
            "labels",
        )
        changed = not moved.filter("component <> was").isEmpty()
        drop_stored(labels)
        labels = moved
        if not changed:
            drop_stored(sides)
            return labels.select("id", "component")
