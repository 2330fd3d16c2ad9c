from __future__ import annotations

from collections import Counter, defaultdict

import zlib

from helpers_llm import AWKWARD, documents
from pulseframe.llm import sharding
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def lawful(rows, n_shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows) and set(counts) <= set(range(n_shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = sharding.shard(table(spark, SF, "documents"), 40).collect()
    lawful(rows, 40)
    where = defaultdict(set)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        where[raw].add(r["shard"])
    assert sum(len(v) - 1 for v in where.values()) <= 2  # groups are cut only where a shard is full


def spread_of(spark, rows, n_shards):
    """The shards of each text, and in how many places its documents are cut apart."""
    out = sharding.shard(documents(spark, rows), n_shards).collect()
    lawful(out, n_shards)
    texts, shards = dict(rows), defaultdict(set)
    for r in out:
        shards[texts[r["doc_id"]]].add(r["shard"])
    return shards, sum(len(v) - 1 for t, v in shards.items() if t != "same text")


def test_a_group_larger_than_a_shard_fills_few(spark):
    rows = [(i, "same text") for i in range(400)] + [(1000 + i, f"text {i // 3}") for i in range(300)]
    rows += [(2000 + i, f"alone {i}") for i in range(300)]
    shards, cut = spread_of(spark, rows, 10)
    assert len(shards["same text"]) <= 8 and cut <= 10  # of 100 groups


def test_fewer_cuts_than_by_chance_when_every_document_is_linked(spark):
    rows = [(i, "same text") for i in range(400)] + [(1000 + i, f"text {i // 3}") for i in range(600)]
    _, cut = spread_of(spark, rows, 10)
    assert cut <= 110  # of 200 groups; 340 by chance


def test_propagation_cuts_fewer_links_each_round(spark):
    links = spark.createDataFrame([(i, i // 4) for i in range(800)], "id long, hub long")

    def cut(rounds):
        label = {r["id"]: r["label"] for r in sharding.propagate(links, 2000, 8, rounds, settle=False).collect()}
        return sum(len({label[4 * h + k] for k in range(4)}) - 1 for h in range(200))

    first, last = cut(0), cut(8)
    assert last < first / 10


def test_documents_of_several_hubs(spark):
    links = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, 11), (3, 11)], "id long, hub long")
    assert sharding.propagate(links, 100, 4, 12).count() == 3


def test_awkward_rows(spark):
    rows = sharding.shard(documents(spark, AWKWARD, extra=True), 4).collect()
    lawful(rows, 4)
    got = {r["doc_id"]: r for r in rows}
    assert (got[1]["size"], got[1]["text_crc32"]) == (16, 0) and got[6]["size"] == len(AWKWARD[6][1].encode()) + 16
    lawful(sharding.shard(documents(spark, []), 4).collect(), 4)
    lawful(sharding.shard(documents(spark, AWKWARD[:2]), 40).collect(), 40)


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(documents(spark, AWKWARD[3:6]), 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
