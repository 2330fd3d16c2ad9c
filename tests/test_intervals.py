"""Coverage as islands, and what is left to ask for."""

from __future__ import annotations

import datetime as dt
import random

from helpers import rows
from pyspark.sql import functions as F

from pulseframe.functions.dates import day_sequence
from pulseframe.operators import calendar, intervals

D0 = dt.date(2024, 2, 20)


def day(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


def spans(spark, items):
    return spark.createDataFrame([(g, day(a) if a is not None else None, day(b) if b is not None else None) for g, a, b in items], "g string, start_date date, end_date date")


def held(items, g) -> set[int]:
    return {d for w, a, b in items if w == g and a is not None and b is not None for d in range(a, b + 1)}


def longest(days: set[int]) -> list[tuple[int, int]]:
    out = []
    for d in sorted(days):
        if out and out[-1][1] == d - 1:
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def test_open_and_merged_intervals_equal_sets_of_days(spark):
    rng = random.Random(5)
    draw = lambda n: [(f"g{rng.randrange(6)}", a, a + rng.randrange(-2, 9)) for a in (rng.randrange(40) for _ in range(n))]
    for n in (0, 3, 25):
        asked, had = draw(n), draw(n)
        got = rows(intervals.open_intervals(spans(spark, asked), spans(spark, had), ["g"]))
        want = [(g, day(a), day(b)) for g in {w for w, _, _ in asked} for a, b in longest(held(asked, g) - held(had, g))]
        assert got == sorted(want, key=repr)
        one = rows(intervals.merged_intervals(spans(spark, asked), ["g"]))
        assert one == sorted([(g, day(a), day(b)) for g in {w for w, _, _ in asked} for a, b in longest(held(asked, g))], key=repr)


def test_null_ends_are_no_interval(spark):
    asked, had = [("a", 0, 3), ("a", None, 9), ("b", 4, None)], [("a", 1, None), ("a", 2, 2)]
    assert rows(intervals.open_intervals(spans(spark, asked), spans(spark, had), ["g"])) == [("a", day(0), day(1)), ("a", day(3), day(3))]


def test_islands_expand_to_the_days_and_gaps(spark):
    rng = random.Random(3)
    data = [(f"g{rng.randrange(4)}", day(rng.randrange(60))) for _ in range(90)] + [("g1", None), (None, day(3)), (None, day(4))]
    facts = spark.createDataFrame(data, "g string, d date")
    found = intervals.coverage_islands(facts, ["g"], "d")
    expand = lambda a, b: found.select("g", F.explode(day_sequence(a, b)).alias("date_day"))
    assert rows(expand(F.col("start_date"), F.col("end_date"))) == rows(facts.filter("d is not null").distinct())
    gaps = expand(F.date_add("end_date", 1), F.date_add(F.col("end_date"), F.col("gap_days")))
    assert rows(gaps.filter("g is not null")) == rows(calendar.gap_days(facts.filter("g is not null and d is not null"), ["g"], "d"))
    assert found.agg(F.sum("num_days")).first()[0] == facts.filter("d is not null").distinct().count()


def test_islands_reduce_facts_before_the_shuffle(spark):
    facts = spark.range(100_000).select(F.lit("hot").alias("g"), F.expr("date_add(date'2024-01-01', cast(id % 40 as int))").alias("d"))
    found = intervals.coverage_islands(facts, ["g"], "d")
    assert rows(found) == [("hot", dt.date(2024, 1, 1), dt.date(2024, 2, 9), 40, None)]
