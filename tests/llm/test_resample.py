from __future__ import annotations

import numpy as np
from helpers_llm import AWKWARD, by_id, documents
from pulseframe.llm import resample
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"  # a model of words needs some thousand documents
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = by_id(resample.resample(docs, labels))
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [got[d]["selected"] for d, q in marks.items() if q == 1 and d in got]
    bad = [got[d]["selected"] for d, q in marks.items() if q == 0 and d in got]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05
    kept = resample.selected(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {d for d, r in got.items() if r["selected"]}


def test_weights_are_the_ratio_of_the_two_models(spark):
    rows = [(i, "good clean words here" if i % 3 else "junk ### junk ###") for i in range(40)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], LABELS)
    sample = resample.labelled_sample(labels)
    ratio = resample.fit(docs, sample)
    wanted = {r["doc_id"] for r in sample.filter("good and fold = 0").collect()}
    grams = resample.Grams()
    raw, target = np.ones(resample.BUCKETS), np.ones(resample.BUCKETS)
    for i, t in rows:
        np.add.at(raw, grams.buckets(t), 1)
        if i in wanted:
            np.add.at(target, grams.buckets(t), 1)
    exact = np.log(target / target.sum() / (raw / raw.sum()))
    assert np.allclose(ratio, exact)
    got = by_id(resample.resample(docs, labels))
    assert all(abs(got[i]["log_weight"] - exact[grams.buckets(t)].sum()) < 1e-9 for i, t in rows)


def test_top_k_takes_the_largest_keys(spark):
    got = by_id(resample.resample(table(spark, SF, "documents"), table(spark, SF, "labels"), k=137))
    order = sorted(got.values(), key=lambda r: (-r["gumbel_key"], r["doc_id"]))
    assert {r["doc_id"] for r in order[:137]} == {d for d, r in got.items() if r["selected"]}


def test_sampling_follows_the_weights(spark):
    """Keys of equal log weight are exchangeable; a larger weight wins in proportion."""
    n = 4000
    docs = documents(spark, [(i, "a b") for i in range(n)])
    ratio = np.zeros(resample.BUCKETS)
    keys = np.array([r["_key"] for r in resample.scored(docs, ratio).orderBy("doc_id").collect()])
    wins = np.mean(keys[: n // 2] + np.log(3) > keys[n // 2 :])
    assert abs(wins - 0.75) < 0.03


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, None), (7, 1, None), (None, 1, 0), (5, 1, 0), (5, 0, 0)], LABELS)
    rows = resample.resample(docs, labels).collect()
    assert len(rows) == len(AWKWARD)
    assert all(not r["selected"] and r["log_weight"] is None for r in rows if r["doc_id"] in (1, 2, 3))
    assert resample.selected(docs, labels).columns == docs.columns


def test_without_labels_and_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert all(r["selected"] for r in resample.resample(documents(spark, [(1, "a b c")]), none).collect())
    assert resample.resample(documents(spark, []), none).count() == 0
    assert resample.resample(documents(spark, []), none, k=5).count() == 0
