from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def column(df: DataFrame, name: str) -> list:
    return sorted((r[0] for r in df.select(name).collect()), key=repr)


def variants(spark: SparkSession, *texts: str) -> DataFrame:
    """One row per JSON text: ``n`` and VARIANT ``v``."""
    return spark.createDataFrame(list(enumerate(texts)), "n int, j string").select("n", F.parse_json("j").alias("v"))


def detail_envelope(spark: SparkSession, payloads: dict[str, dict | list]) -> DataFrame:
    data = [(k, json.dumps(v)) for k, v in payloads.items()]
    return spark.createDataFrame(data, "natural_key string, j string").select(
        "natural_key", F.parse_json("j").alias("raw_data")
    )


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
