"""A training corpus from raw documents, in five stages.

Documents the quality classifier rejects go, one document of each near-duplicate group stays,
documents that hold benchmark passages go, the sources are interleaved at their target weights, and
the result is dealt into shards that keep linked documents together. Each stage gets what its
predecessor kept, written as Parquet and read again.

The mix keeps every document: its decision is the order, so the stage's files hold the documents
in the order of the mix, and so do the slots of each shard. The last stage reads that order from the
files it gets: a row's place is the number of its file and its place in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from pulseframe.llm import decontaminate, mixing, near_dup, resample, sharding
from pulseframe.llm.common import store, table

N_SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the importance-resampling classifier selects; null, empty and blank texts go, repeated rows all stay or go."""
    return resample.selected(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; of repeated rows one, of null texts all."""
    return near_dup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none, repeated rows all stay or go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, null and repeated ones too, in the order of the mix; a null source is one of its own."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; the slots of a shard are in the order of the mix.

    That is the order of the stored table. Documents that are not rows of stored files are mixed here.
    Null texts weigh 16 bytes and are linked with nothing; repeated rows are rows of their own; no documents give no rows.
    """
    if _stored(docs):
        return sharding.shard(docs, N_SHARDS, place=sharding.file_place())
    places = mixing.mix(docs).select(F.col("doc_id").alias("id"), "position")
    return sharding.shard(docs, N_SHARDS, places=places)


def _stored(docs: DataFrame) -> bool:
    """Whether the rows of ``docs`` know their files."""
    try:
        docs.select(sharding.file_place())
    except AnalysisException as unknown:
        if unknown.getCondition() != "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise
        return False
    return True


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]

# Models, alignments and propagation cannot be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
