"""Random inputs against plain Python."""

from __future__ import annotations

import datetime as dt
import json

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.operators import normalize, watermarks
from pulseframe.operators.upsert import latest_by_key, upsert

quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

BATCH = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 99)), max_size=5)


def landed(spark, batch, seq):
    data = [(k, x, seq, i) for i, (k, x) in enumerate(batch)]
    return spark.createDataFrame(data, "natural_key string, x int, batch_seq long, row_seq long")


@quick
@given(st.lists(BATCH, min_size=1, max_size=4), st.randoms())
def test_upsert_is_a_dictionary_whatever_the_arrival_order(spark, batches, random):
    want = {}
    for batch in batches:
        want.update(batch)
    arrivals = list(enumerate(batches)) + [(i, b) for i, b in enumerate(batches) if random.random() < 0.3]
    random.shuffle(arrivals)
    current = landed(spark, [], 0)
    log = landed(spark, [], 0)
    for seq, batch in arrivals:
        current = upsert(current, landed(spark, batch, seq))
        log = log.unionByName(landed(spark, batch, seq))
    expected = sorted(want.items(), key=repr)
    assert rows(current.select("natural_key", "x")) == expected
    assert rows(latest_by_key(log).select("natural_key", "x")) == expected


VALUE = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-3, 30000000),
    st.sampled_from(["", "0", "2024-01-05", "false", " "]),
    st.sampled_from([[], {}, 0.0, 0.5]),
)
ITEM = st.one_of(
    st.dictionaries(st.sampled_from(["calendarDate", "date", "summaryDate", "x"]), VALUE),
    st.integers(0, 2),
    st.lists(st.integers(0, 2), max_size=2),
)


def python_keys(payload, start):
    """Keys a dynamic language derives from truthiness alone."""
    found = []
    for i, item in enumerate([payload] if isinstance(payload, dict) else payload):
        dated = [item.get(f) for f in normalize.DATE_KEY_FIELDS] if isinstance(item, dict) else []
        found.append(str(next(filter(None, dated), f"{start}_{i}")))
    return found


@quick
@given(st.lists(st.one_of(st.lists(ITEM, max_size=4), ITEM.filter(lambda v: isinstance(v, dict))), min_size=1, max_size=8))
def test_range_keys_follow_truthiness(spark, payloads):
    data = [(dt.date(2024, 1, 1) + dt.timedelta(27 * i), json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(data, "chunk_start date, payload string").withColumn("source_method", F.lit("m"))
    want = [k for (start, _), p in zip(data, payloads) if p for k in python_keys(p, start.isoformat())]
    got = [r[0] for r in normalize.normalize_range(df).select("natural_key").collect()]
    assert sorted(got) == sorted(want)


@quick
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(-3, 200)), min_size=1, max_size=6), st.integers(1, 40))
def test_chunks_cover_each_day_once(spark, spans, size):
    first = dt.date(2023, 12, 1)
    data = [(i, first + dt.timedelta(a), first + dt.timedelta(a + n)) for i, (a, n) in enumerate(spans)]
    df = spark.createDataFrame(data, "k int, start_date date, end_date date")
    got = {}
    for r in watermarks.chunk_ranges(df, max_days=size).collect():
        days = (r.chunk_end - r.chunk_start).days + 1
        assert 1 <= days <= size
        got.setdefault(r.k, []).extend(r.chunk_start + dt.timedelta(j) for j in range(days))
    for k, start, end in data:
        assert sorted(got.get(k, [])) == [start + dt.timedelta(j) for j in range((end - start).days + 1)]
