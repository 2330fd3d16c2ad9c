from __future__ import annotations

import random

from pulseframe.llm.common import components, ranked, scratch
from pyspark.sql import functions as F


def test_rank_is_the_place_in_the_order(spark):
    rows = [(0 if i % 3 else i, i) for i in range(500)]  # one key holds two thirds
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, i int")
    got = {r["i"]: r["rank"] for r in ranked(df, [F.col("k"), F.col("i")], "t").collect()}
    assert got == {i: n for n, (k, i) in enumerate(sorted(rows))}


def test_rank_of_nothing_and_of_equal_rows(spark):
    df = spark.createDataFrame([], "k int")
    assert ranked(df, [F.col("k")], "t").count() == 0
    same = spark.createDataFrame([(1,)] * 50, "k int")
    assert sorted(r["rank"] for r in ranked(same, [F.col("k")], "t").collect()) == list(range(50))


def test_components_of_chains_stars_and_random_edges(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1400)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(5, 5), (7, 1000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
