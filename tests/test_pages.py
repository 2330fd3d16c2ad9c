"""The feed read page by page."""

from __future__ import annotations

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_skew import largest_share, plain_joins  # noqa: F401

from pulseframe.operators.discovery import last_pages, new_until_stop
from pulseframe.operators.upsert import LandedTable
from pulseframe.plans.runs import land_new_activities

SCHEMA = "who string, id string, pos long, page long"


def feed(spark, pages: dict[str, list[list[int]]]):
    """Ids by subject and page, newest first."""
    data = [(who, str(i), -n, p) for who, own in pages.items() for n, (p, i) in enumerate((p, i) for p, ids in enumerate(own) for i in ids)]
    return spark.createDataFrame(data, SCHEMA)


def read(pages: list[list[int]], known: set[int], size: int) -> list[int]:
    out = []
    for page in pages:
        for i in page:
            if i in known:
                return out
            out.append(i)
        if len(page) < size:
            return out
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_reading_in_order(spark, seed):
    rng = random.Random(seed)
    pages, known, n = {}, {}, 0
    for s in range(12):
        own = []
        for _ in range(rng.randrange(1, 7)):
            k = rng.choice([3, 3, 3, 3, 2, 0])
            own.append(list(range(n, n + k)))
            n += k
        pages[f"s{s}"] = own
        known[f"s{s}"] = {i for p in own for i in p if rng.random() < 0.06}
    have = spark.createDataFrame([(w, str(i)) for w, ids in known.items() for i in ids], "who string, id string")
    got = new_until_stop(feed(spark, pages), have, "id", "pos", "page", "who", size=3)
    want = sorted((w, str(i)) for w, own in pages.items() for i in read(own, known[w], 3))
    assert rows(got.select("who", "id")) == want
    assert got.columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ")


def test_one_feed_without_subjects(spark):
    whole = feed(spark, {"x": [[9, 8], [7, 6], [5], [4, 3]]}).drop("who")
    none = spark.createDataFrame([], "id string")
    known = spark.createDataFrame([("7",), ("3",)], "id string")
    assert rows(new_until_stop(whole, none, "id", "pos", "page", size=2).select("id")) == [("5",), ("6",), ("7",), ("8",), ("9",)]
    assert rows(new_until_stop(whole, known, "id", "pos", "page", size=2).select("id")) == [("8",), ("9",)]
    assert new_until_stop(whole.limit(0), known, "id", "pos", "page", size=2).count() == 0


def test_missing_first_page_and_odd_page_numbers(spark):
    data = [("a", "1", 9, 1), ("a", "2", 8, 1), ("b", "3", 7, None), ("b", "4", 6, -1), ("b", "5", 5, 0), ("b", "6", 4, 0), ("c", "7", 3, 0)]
    got = new_until_stop(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], "who string, id string"), "id", "pos", "page", "who", size=2)
    assert rows(got.select("id")) == [("5",), ("6",), ("7",)]
    last = last_pages(spark.createDataFrame(data, SCHEMA), "page", "who", 2)
    assert rows(last) == [("a", 0), ("b", 1), ("c", 0)]


def test_a_hot_subject_is_spread(spark, plain_joins):  # noqa: F811
    hot = 6000
    data = spark.range(2 * hot).select(
        F.when(F.col("id") < hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("who"),
        F.col("id").cast("string").alias("key"), (-F.col("id")).alias("pos"),
        F.when(F.col("id") < hot, F.floor(F.col("id") / 10)).otherwise(F.floor((F.col("id") - hot) / 500)).alias("page"),
    )
    short = data.filter("key <> '4005'")  # page 400 of the hot subject lacks one
    known = spark.createDataFrame([], "who string, key string")
    got = new_until_stop(short, known, "key", "pos", "page", "who", size=10)
    assert largest_share(got, "who = 'hot'") < 0.4
    assert got.filter("who = 'hot'").count() == 4009


def test_a_run_lands_the_pages_it_reaches(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), ("collector_name", "subject_id", "natural_key"), ("collector_name",))
    data = [(1, str(i), -i, i // 100, "{\"a\":1}") for i in range(150)] + [(2, str(i), -i, i // 100, "{\"a\":1}") for i in range(250) if i != 7]
    df = spark.createDataFrame(data, "subject_id long, natural_key string, pos long, page long, payload string")
    assert land_new_activities(table, df, "pos", "2024-02-01T10:00:00Z", 1, "page") == 150 + 99
