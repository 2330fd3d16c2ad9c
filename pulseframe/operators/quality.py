"""Column-level data tests. A test returns its failing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_failures(df: DataFrame, *cols: str) -> DataFrame:
    """Key values occurring more than once (NULLs are not compared), with their count.

    Counts are combined in each task before the shuffle, so a value copied into
    a third of the rows costs one row per task.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    counted = df.filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def _key_text(key: list[str]) -> Column:
    """The values of a key as one text: each with its length before it, so no two keys look alike."""
    texts = [F.col(c).cast("string") for c in key]
    return F.concat(*[F.concat(F.length(t), F.lit(":"), t) for t in texts])


def data_test_report(models: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Row and failure counts of ``unique`` and ``not_null`` for each ``{model: (frame, key columns)}``.

    The keys of all models are counted in one grouping, so a report has one shuffle however many
    models there are; each task counts before it. Keys with a NULL are counted together.
    """
    spark = next(iter(models.values()))[0].sparkSession
    keys = []
    for model, (df, key) in models.items():
        keys.append(df.select(F.lit(model).alias("model"), _key_text(key).alias("_key")))  # null if any part is
    counted = reduce(DataFrame.unionByName, keys).groupBy("model", "_key").agg(F.count(F.lit(1)).alias("_n"))
    is_null = F.col("_key").isNull()
    summary = counted.groupBy("model").agg(
        F.sum("_n").alias("num_rows"),
        F.count(F.when(~is_null & (F.col("_n") > 1), 1)).alias("unique"),
        F.sum(F.when(is_null, F.col("_n")).otherwise(0)).alias("not_null"),
    )
    named = spark.createDataFrame([(m, ",".join(key)) for m, (_, key) in models.items()], "model string, key_columns string")
    counts = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("num_rows", "unique", "not_null")}
    return (
        named.join(summary, "model", "left")  # a model without rows is reported as well
        .withColumns(counts)
        .unpivot(["model", "key_columns", "num_rows"], ["unique", "not_null"], "test", "failures")
        .select("model", "key_columns", "test", "num_rows", "failures")
    )
