from __future__ import annotations

from collections import Counter

import corpus_pipeline
from helpers_llm import AWKWARD, documents
from pulseframe.llm import decontaminate, mixing, near_dup, resample
from pulseframe.llm.common import store, table

SF = "/root/testdata/sf0.001"


def test_run_keeps_what_each_stage_alone_keeps(spark):
    docs = table(spark, SF, "documents")
    good = resample.resample(docs, table(spark, SF, "labels")).filter("selected").select("doc_id")
    docs = docs.join(good, "doc_id")
    one = near_dup.near_duplicates(docs).filter("kept").select("doc_id")
    docs = docs.join(one, "doc_id")
    leaks = {r["doc_id"] for r in decontaminate.contamination(docs, table(spark, SF, "benchmark")).collect()}
    want = sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] not in leaks)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == want and len(want) > 100
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(corpus_pipeline.N_SHARDS)) <= 1


def test_stages_return_the_columns_of_documents(spark):
    docs = documents(spark, [*AWKWARD, *[(100 + i, f"clean words in document number {i} and {i * 7}", "en", "a") for i in range(20)]], extra=True)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    ids = [r["doc_id"] for r in rows]
    assert 1 not in ids and 2 not in ids and ids.count(5) <= 1 and len(rows) > 15


def test_stages_of_nothing(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_slots_of_a_shard_follow_the_mix(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = [r["doc_id"] for r in rows]
    docs = table(spark, SF, "documents")
    kept = docs.filter(docs["doc_id"].isin(ids))
    position = {r["doc_id"]: r["position"] for r in mixing.mix(kept).collect()}
    shards = {}
    for r in sorted(rows, key=lambda r: (r["shard"], r["slot"])):
        shards.setdefault(r["shard"], []).append((r["slot"], position[r["doc_id"]]))
    for slots in shards.values():
        assert [s for s, _ in slots] == list(range(len(slots)))
        assert [p for _, p in slots] == sorted(p for _, p in slots)


def test_every_shard_is_interleaved_at_the_target_weights(spark):
    rows = [(i, f"clean text number {i}", "en", "big" if i < 3200 else f"small{i % 2}") for i in range(4800)]
    placed = corpus_pipeline.shards(spark, documents(spark, rows), SF).collect()
    source = {i: s for i, _, _, s in rows}
    weights = {r["source"]: r["weight"] for r in mixing.mix(documents(spark, rows)).select("source", "weight").distinct().collect()}
    early = [source[r["doc_id"]] for r in placed if r["slot"] < 30]  # a quarter of each shard
    for s, w in weights.items():
        assert abs(early.count(s) / len(early) - w) < 0.05
    assert weights["big"] < 0.6 < 3200 / 4800


def test_the_last_stage_reads_the_mix_from_its_files_without_python(spark, monkeypatch):
    rows = [(i, f"clean text number {i}", "en", "big" if i < 400 else f"small{i % 2}") for i in range(600)]
    docs = documents(spark, rows)
    position = {r["doc_id"]: r["position"] for r in mixing.mix(docs).collect()}
    stored = store(corpus_pipeline.mix(spark, docs, SF), "mixed")
    monkeypatch.setattr(mixing, "mix", None)  # it is not worked out again
    placed = corpus_pipeline.shards(spark, stored, SF)
    plan = placed._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    shards = {}
    for r in sorted(placed.collect(), key=lambda r: (r["shard"], r["slot"])):
        shards.setdefault(r["shard"], []).append(position[r["doc_id"]])
    assert sum(map(len, shards.values())) == 600 and all(p == sorted(p) for p in shards.values())
