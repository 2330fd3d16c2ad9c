from __future__ import annotations

import numpy as np
from pulseframe.llm import vectors
from pulseframe.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple]) -> dict:
    good = [(i, np.array(v, dtype=np.float64)) for i, v, *_ in rows if v is not None and len(v) and all(e is not None for e in v)]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    links = {i: set() for i, *_ in rows}
    for a, (i, v) in enumerate(good):
        for j, w in good[a + 1 :]:
            if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.9:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in sorted(links):
        if i not in out:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j)
                    todo.append(j)
            out |= {j: i for j in seen}
    return {i: (len(links[i]), out[i], out[i] == i) for i in links}


def results(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}


def test_equals_all_pairs(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    assert results(table(spark, "/root/testdata/sf0.01", "embeddings")) == brute(rows)


def clustered(rng, n, dim, near):
    base = rng.normal(size=(n // 10, dim))
    x = base[rng.integers(0, len(base), n)] + near * rng.normal(size=(n, dim))
    return [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]


def test_links_near_the_bound_are_found_by_target_recall_and_none_below(spark):
    rows = clustered(np.random.default_rng(7), 1500, 16, 0.33)  # neighbours around the bound
    want, got = brute(rows), results(spark.createDataFrame(rows, SCHEMA))
    found, there = (sum(r[0] for r in x.values()) for x in (got, want))
    assert 0.9 * there <= found <= there and there > 5000
    assert all(got[i][0] <= want[i][0] for i in want)


def test_a_dominant_group_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(8)
    rows = clustered(rng, 300, 8, 0.02)
    one = rng.normal(size=8)
    rows += [(1000 + i, (one + 0.01 * rng.normal(size=8)).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(2000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5], 1) for i in range(100)]
    assert results(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_the_walk_visits_cells_by_distance():
    rng = np.random.default_rng(9)
    for _ in range(20):
        a, b = np.sort(rng.random(7)), np.sort(rng.random(5))
        got = vectors.walk(a, b, np.arange(7), np.arange(5), 35)
        cost = [a[c // 5] + b[c % 5] for c in got]
        assert sorted(got) == list(range(35)) and cost == sorted(cost)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [1.0, 2.0], 0), (8, [2.0, 4.0], 1), (9, [1.0], 0), (10, [3.0], 0), (11, [-1.0, -2.0], 0), (7, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS n", "4 AS cell")
    got = results(df)
    want = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 11)} | {7: (1, 7, True), 8: (1, 7, False), 9: (1, 9, True), 10: (1, 9, False)}
    assert got == want
    assert results(spark.createDataFrame([], SCHEMA)) == {}


def planted(rng, n, hot, dim=64, size=3):
    """``hot`` near copies of one vector, and small groups at cosines of 0.90 to 0.95; links are known."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.normal(size=((n - hot) // size, dim)))
    side = rng.normal(size=(len(base), size - 1, dim))
    side = unit(side - (side * base[:, None]).sum(2, keepdims=True) * base[:, None])
    c = rng.uniform(0.905, 0.95, (len(base), size - 1, 1))
    small = np.concatenate([base[:, None], c * base[:, None] + np.sqrt(1 - c * c) * side], axis=1).reshape(-1, dim)
    return unit(rng.normal(size=dim) + 0.01 * rng.normal(size=(hot, dim))), small


def test_small_groups_beside_a_hot_third_reach_the_target(spark):
    hot, small = planted(np.random.default_rng(11), 9000, 3000)
    x = np.concatenate([small, hot]).astype(np.float32)
    want = (small @ small.T >= 0.9).sum() - len(small)
    got = results(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA))
    found = sum(got[i][0] for i in range(len(small)))
    assert 0.995 * want <= found <= want + 2 and want > 8000
    assert all(got[i][0] == len(hot) - 1 for i in range(len(small), len(x)))


def test_links_the_sample_does_not_meet_are_found(spark):
    rng = np.random.default_rng(12)
    far = rng.normal(size=(12000, 64))
    _, small = planted(rng, 90, 0)
    x = np.concatenate([small, far]).astype(np.float32)
    got = results(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA))
    want = (small @ small.T >= 0.9).sum() - len(small)
    assert sum(got[i][0] for i in range(len(small))) >= 0.97 * want
