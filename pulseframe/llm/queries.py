"""The operators' registered queries over the driver tables, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import decontaminate, language, licenses, line_rules, lm, mixing, near_dup, pii, prefix_trie, repair, resample, sharding, vectors
from pulseframe.llm.common import store, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark, sf):
    """Every document and benchmark item that meet, with the best window."""
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_license_scan(spark, sf):
    """Every document's licence; its path is made of source, language and id."""
    docs = table(spark, sf, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string"))
    found = licenses.scan(docs.filter("doc_id is not null").select(path.alias("path"), "text"))
    return found.select(F.regexp_extract("path", r"([^/]*)$", 1).cast("long").alias("doc_id"), "path", "licence", "origin", "cosine", "n_notices", "unit")


ORACLES["op2_license_scan"] = f"""
SELECT CAST(regexp_extract(path, '([^/]*)$', 1) AS BIGINT) AS doc_id, path, licence, origin, cosine, n_notices, unit
FROM ({licenses.oracle("documents", "concat_ws('/', coalesce(source, ''), coalesce(lang, ''), CAST(doc_id AS VARCHAR))")})
"""


@query
def op3_near_dup(spark, sf):
    """Every document's class of equal texts and near-duplicate group."""
    return near_dup.near_duplicates(table(spark, sf, "documents"))


@query
def op4_language_id(spark, sf):
    """Every document's language, and how sure that is."""
    return language.identify(table(spark, sf, "documents"))


@query
def op5_quality_resampling(spark, sf):
    """Every document's log weight, noisy key and whether it is selected."""
    return resample.resample(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op6_pii(spark, sf):
    """Every document's base counts and digest, and all its spans."""
    return pii.find(table(spark, sf, "documents")).drop("redacted")


@query
def op7_mixing(spark, sf):
    """Every document's slot and place in the mix."""
    return mixing.mix(table(spark, sf, "documents"))


@query
def op8_embedding_near_dup(spark, sf):
    """Every vector's links and group."""
    return vectors.near_vectors(table(spark, sf, "embeddings"))


ORACLES["op8_embedding_near_dup"] = """
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(id, to_id) AS (SELECT a, b FROM link UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.to_id = link.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(c, e.vec_id)) AS component_id, least(e.vec_id, coalesce(c, e.vec_id)) = e.vec_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON e.vec_id = l.a
LEFT JOIN (SELECT id, min(to_id) AS c FROM reach GROUP BY id) r ON e.vec_id = r.id
"""


@query
def op9_sharding(spark, sf):
    """Every document's shard and slot."""
    placed = sharding.shard(table(spark, sf, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op10_lm_scoring(spark, sf):
    """Every document's unigram and class-model probability."""
    return lm.score(table(spark, sf, "documents"))


@query
def op11_prefix_trie(spark, sf):
    """Every node of the trie of branched conversations, with its subtree's totals."""
    turns = prefix_trie.turns_in_order(table(spark, sf, "conversations"))
    return prefix_trie.trie_totals(prefix_trie.branched(store(turns, "turns")))


ORACLES["op11_prefix_trie"] = prefix_trie.oracle()


@query
def op12_structure_repair(spark, sf):
    """Every damaged conversation's faults, cheapest edits and repaired digest."""
    return repair.repair_report(table(spark, sf, "conversations"))


ORACLES["op12_structure_repair"] = repair.oracle()


@query
def op13_line_rules(spark, sf):
    """Every document's counts, the lines each rule removes, and the verdict."""
    return line_rules.line_rules(table(spark, sf, "documents")).drop("cleaned")


ORACLES["op13_line_rules"] = line_rules.oracle("documents")
