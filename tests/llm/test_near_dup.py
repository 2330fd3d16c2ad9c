from __future__ import annotations

import random
from collections import Counter

import numpy as np
from helpers_llm import AWKWARD, by_id, documents
from pulseframe.llm import near_dup
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def shingles(text: str) -> list[tuple]:
    w = text.lower().split()
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def grouped(docs: list[tuple[int, str]], linked) -> dict[int, int]:
    """Component by smallest id, over all pairs that share a shingle."""
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where: dict[tuple, list[int]] = {}
    bags = {d: shingles(t) for d, t in docs}
    texts = dict(docs)
    pairs = set()
    for d, bag in bags.items():
        for s in set(bag):
            pairs.update((o, d) for o in where.setdefault(s, []))
            where[s].append(d)
    first: dict[str, int] = {}
    for d, t in sorted(docs):
        pairs.add((first.setdefault(t, d), d))
    for a, b in pairs:
        if a != b and (texts[a] == texts[b] or linked(bags[a], bags[b])):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: find(d) for d, _ in docs}


def ordered(a: list[tuple], b: list[tuple]) -> bool:
    """The similarity by its definition: longest common chain of labelled shingles."""
    overlap = sum((Counter(a) & Counter(b)).values())
    if overlap / (len(a) + len(b) - overlap) < 0.8:
        return False  # a chain is no longer than the overlap

    def label(x):
        seen: Counter = Counter()
        out = []
        for s in x:
            out.append((s, seen[s]))
            seen[s] += 1
        return out

    place = {s: i for i, s in enumerate(label(b))}
    run = [place[s] for s in label(a) if s in place]
    best: list[int] = []
    for i, x in enumerate(run):
        best.append(1 + max([best[k] for k in range(i) if run[k] < x], default=0))
    chain = max(best, default=0)
    return chain / (len(a) + len(b) - chain) >= 0.8


def test_equals_all_pairs_on_the_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = by_id(near_dup.near_duplicates(table(spark, SF, "documents")))
    want = grouped(docs, ordered)
    assert {d: r["cluster_id"] for d, r in got.items()} == want
    assert {d for d, r in got.items() if r["kept"]} == set(want.values())


def noisy(rng, words, share):
    return " ".join(rng.choice(["zu", "ba", "ke"]) + str(rng.randrange(999)) if rng.random() < share else w for w in words)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(4000)}" for _ in range(300)]
    docs = [(i, noisy(rng, base, 0.012)) for i in range(150)] + [(1000 + i, noisy(rng, base, 0.5)) for i in range(40)]
    docs += [(2000 + i, "shared passage of words that all of these have in common here " * 3 + noisy(rng, base, 1.0)) for i in range(40)]
    got = by_id(near_dup.near_duplicates(documents(spark, docs)))
    assert {d: r["cluster_id"] for d, r in got.items()} == grouped(docs, ordered)


def test_similarity_is_the_share_of_the_common_chain():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a = rng.integers(0, 40, 60).astype("<u4")
        b = np.delete(a, rng.integers(0, 60, 2)) if rng.random() < 0.7 else rng.permutation(a)
        x, y = near_dup.labelled(a, 2), near_dup.labelled(b, 2)
        place = {s: i for i, s in enumerate(y.tolist())}
        run = [place[s] for s in x.tolist() if s in place]
        best: list[int] = []
        for i, v in enumerate(run):
            best.append(1 + max([best[k] for k in range(i) if run[k] < v], default=0))
        chain = max(best, default=0)
        exact = chain / (len(x) + len(y) - chain)
        got = near_dup.similarity(x, y, 0.5)
        assert got == (exact if exact >= 0.5 else 0.0)


def test_sketches_follow_order():
    words = np.arange(200, dtype="<u4")
    a = near_dup.sketches(near_dup.labelled(words, 1), 3, 16)
    b = near_dup.sketches(near_dup.labelled(words[::-1].copy(), 1), 3, 16)
    assert a == near_dup.sketches(near_dup.labelled(words, 1), 3, 16)
    assert sum(x == y for x, y in zip(a, b)) < 6  # same words, other order


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(AWKWARD)
    got = {r["doc_id"]: (r["class_id"], r["cluster_id"], r["kept"]) for r in rows}
    assert got[1] == (1, 1, True) and got[2] == (2, 2, True) and got[3] == (3, 3, True)
    assert got[4] == (4, 4, True) and got[5] == (4, 4, False)
    kept = near_dup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == ["1", "2", "3", "4", "6", "7", "None"]


def test_empty_table(spark):
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_unrelated_texts_with_one_shared_passage(spark):
    """They agree in many sketches; no pair of them shares a rare k-mer, so none is aligned."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for _ in range(5000)]
    texts[4321] = texts[17][:-9] + " other"
    got = by_id(near_dup.near_duplicates(documents(spark, list(enumerate(texts)))))
    assert {d: r["cluster_id"] for d, r in got.items() if r["cluster_id"] != d} == {4321: 17}


def test_pairs_of_rare_words_hold_every_pair_that_is_similar_enough(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 5000, 120).astype("<u4")
    rows = []
    for n in range(90):
        w = base.copy()
        at = rng.random(len(w)) < rng.choice([0.01, 0.03, 0.3])
        w[at] = rng.integers(0, 5000, int(at.sum()))
        w = np.delete(w, rng.integers(0, len(w), rng.integers(0, 15)))
        rows.append((f"{n:03}".encode(), f"{n % 7}".encode(), w.astype("<u4").tobytes()))
    rare = near_dup.rare_rows(spark.createDataFrame(rows, "g binary, c binary, words binary"), 5, 0.8)
    found = {(bytes(r["a"]), bytes(r["b"])) for r in near_dup.across_pairs(rare, 0.8).collect()}
    mers = {g: near_dup.labelled(np.frombuffer(w, dtype="<u4"), 5) for g, _, w in rows}
    similar = {(a, b) for a, ca, _ in rows for b, cb, _ in rows if a < b and ca != cb and near_dup.similarity(mers[a], mers[b], 0.8)}
    assert similar and similar <= found
    assert len(found) < 90 * 89 / 2 / 2
    stars = near_dup.star_pairs(rare, 0.8)
    assert 0 < stars.count() <= rare.count()
