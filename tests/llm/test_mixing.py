from __future__ import annotations

import random
import time

import pytest
from helpers_llm import AWKWARD, documents
from pulseframe.llm import mixing
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def test_shares_follow_the_weights_until_a_source_ends(spark):
    docs = table(spark, SF, "documents")
    weights = {f"src{i}": 1 + i % 4 for i in range(20)}
    rows = sorted(mixing.mix(docs, weights, block_rows=3).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1000))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    last = {}
    for r in rows:
        last[r["source"]] = r["slot"]
    end = min(last.values())  # all sources are there up to here
    count = dict.fromkeys(weights, 0)
    blocks = {(r["source"], r["block"]): r for r in rows}
    for r in sorted(blocks.values(), key=lambda r: r["slot"]):
        if r["slot"] > end:
            break
        count[r["source"]] += 1
        for s in weights:
            w = next(x["weight"] for x in rows if x["source"] == s)
            assert abs(count[s] - (r["slot"] + 1) * w) < 1 + 1e-9


def test_weights_are_whole_parts():
    parts = mixing.parts_of({"a": 0.5, "b": 0.3, "c": 0.2, "tiny": 1e-9}, 200)
    assert sum(parts.values()) >= 200 and parts["tiny"] == 1 and parts["a"] in (99, 100)


def test_stage_keeps_rows_and_columns(spark):
    docs = documents(spark, AWKWARD, extra=True)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    key = lambda r: repr(r["doc_id"]) + repr(r["text"])
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.collect()))
    want = [r["doc_id"] for r in sorted(mixing.mix(table(spark, SF, "documents")).collect(), key=lambda r: r["position"])]
    assert [r["doc_id"] for r in mixing.mixed(table(spark, SF, "documents")).collect()] == want


def test_awkward_rows(spark):
    rows = mixing.mix(documents(spark, AWKWARD, extra=True), block_rows=2).collect()
    assert sorted(r["position"] for r in rows) == list(range(len(AWKWARD)))
    assert {r["source"] for r in rows} == {"", "a", "b"}
    assert mixing.mix(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(documents(spark, AWKWARD), {"a": 0.0})


@pytest.mark.parametrize("rows", [[40_000, *[4_200] * 19], [100_000, 100, 7, 1]])
def test_no_source_is_a_block_off_its_exact_target(rows):
    targets = {f"s{i}": n**0.5 for i, n in enumerate(rows)}
    blocks = {f"s{i}": -(-n // 16) for i, n in enumerate(rows)}
    done, total = dict.fromkeys(targets, 0), sum(targets.values())
    for slot, s, block, release, deadline in mixing.Timetable(mixing.exact(targets), blocks):
        assert block == done[s] and release <= slot < deadline
        done[s] += 1
        assert all(abs(done[x] - (slot + 1) * w / total) < 1 + 1e-9 for x, w in targets.items())
        if done[s] == blocks[s]:
            break


def test_mix_keeps_given_weights_however_small_and_long(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SEGMENT", 50)
    docs = spark.range(12_000).selectExpr("id AS doc_id", "CASE WHEN id < 30 THEN 'rare' WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS source")
    weights = {"a": 0.55, "b": 0.449, "rare": 0.001}
    rows = sorted(mixing.mix(docs, weights, block_rows=1).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(12_000)) == [r["slot"] for r in rows]
    done = dict.fromkeys(weights, 0)
    for i, r in enumerate(rows):
        done[r["source"]] += 1
        assert all(abs(done[s] - (i + 1) * w) < 1 + 1e-9 for s, w in weights.items())
        assert r["weight"] == pytest.approx(weights[r["source"]], rel=1e-12)
        if done[r["source"]] == {"a": 5985, "b": 5985, "rare": 30}[r["source"]]:
            break
    assert i > 10_000


def test_segments_go_on_where_the_timetable_stood():
    rng = random.Random(3)
    blocks = {f"s{i}": rng.choice([0, 1, 2, 9, 50, 400]) for i in range(9)}
    parts = mixing.exact({s: rng.random() + 0.001 for s in blocks})
    whole = list(mixing.Timetable(parts, blocks))
    assert [x[0] for x in whole] == list(range(sum(blocks.values())))
    way = mixing.Timetable(parts, blocks)
    for slot, *_ in way:
        if slot % 13 == 0:
            assert list(mixing.Timetable(parts, blocks, way.state())) == whole[slot:]


def test_more_than_a_thousand_sources(spark):
    docs = spark.range(2400).selectExpr("id AS doc_id", "concat('s', id % 1200) AS source")
    assert sorted(r["position"] for r in mixing.mix(docs).collect()) == list(range(2400))


@pytest.mark.parametrize("seed", range(40))
def test_standing_equals_the_walk(seed):
    rng = random.Random(seed)
    parts = mixing.exact({f"s{i}": rng.choice([rng.random() + 0.001, rng.random() ** 4 + 1e-3, 1.0, 0.5]) for i in range(rng.randrange(1, 9))})
    done = dict.fromkeys(parts, 0)
    for slot, s, *_ in mixing.Timetable(parts, dict.fromkeys(parts, 10**9)):
        assert slot % 7 or mixing.standing(parts, parts, slot) == done
        done[s] += 1
        if slot > 400:
            break


@pytest.mark.parametrize("seed", range(12))
def test_phases_begin_where_sources_end(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.choice([0, 1, 2, 9, 50, 400]) for i in range(7)}
    parts = mixing.exact({s: rng.random() + 0.001 for s in blocks})
    want, done = [(0, dict.fromkeys(blocks, 0))] if any(blocks.values()) else [], dict.fromkeys(blocks, 0)
    for slot, s, *_ in mixing.Timetable(parts, blocks):
        done[s] += 1
        if done[s] == blocks[s] and slot + 1 < sum(blocks.values()):
            want.append((slot + 1, dict(done)))
    assert mixing.phases(parts, blocks) == want


def test_the_driver_does_not_walk_the_blocks():
    parts = mixing.exact({f"s{i}": (10.0 ** (i % 7)) ** 0.5 for i in range(30)})
    began = time.process_time()
    assert len(mixing.phases(parts, dict.fromkeys(parts, 10**8))) >= 7
    assert time.process_time() - began < 20
