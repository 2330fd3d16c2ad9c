"""A dominant key must not end up in one task."""

from __future__ import annotations

import pytest
from helpers import detail_envelope, plan, rows
from pyspark.sql import functions as F

from pulseframe.operators import discovery, quality, samples
from pulseframe.operators.upsert import latest_by_key

HOT = 2000


@pytest.fixture
def plain_joins(spark):
    """No broadcast and no coalescing: what a join does once both sides are large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df, condition) -> float:
    """Part of the matching rows held by the fullest task."""
    counts = [r[1] for r in df.filter(condition).groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def hot_series(spark):
    def activity(n):
        keys = ("directLatitude", "directHeartRate")
        return {
            "metricDescriptors": [{"metricsIndex": i, "key": k, "unit": {"key": "u"}} for i, k in enumerate(keys)],
            "activityDetailMetrics": [{"metrics": [i, 2 * i]} for i in range(n)],
        }

    payloads = {"hot": activity(HOT), **{f"a{i}": activity(10) for i in range(20)}}
    return samples.series_from_envelope(detail_envelope(spark, payloads))


def test_long_forms_spread_a_hot_activity(spark, plain_joins):
    series = hot_series(spark)
    joined = samples.unpivot_join(samples.explode_descriptors(series), samples.explode_samples(series))
    kept = samples.gps_samples_long(samples.unpivot(series))
    for df in (joined, kept):
        assert "BroadcastHashJoin" not in plan(df)
        assert largest_share(df, "activity_id = 'hot'") < 0.4
        assert df.count() == 2 * (HOT + 200)


def test_feed_of_a_hot_subject_is_spread(spark, plain_joins):
    feed = spark.range(3 * HOT).select(
        F.col("id").cast("string").alias("activity"),
        F.when(F.col("id") < HOT, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("who"),
        F.col("id").alias("pos"),
    )
    known = feed.filter("pos in (9, 2500)").select("activity", "who")
    fresh = discovery.new_until_known_by(feed, known, "activity", "pos", "who")
    assert largest_share(fresh, "who = 'hot'") < 0.4
    # Position 2500 is the eleventh of its subject's eighty.
    assert fresh.count() == 3 * HOT - 10 - 11


def test_reductions_run_before_the_shuffle(spark, plain_joins):
    log = spark.range(3 * HOT).select(
        F.when(F.col("id") < HOT, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("natural_key"),
        F.col("id").alias("batch_seq"),
        F.lit("x").alias("payload"),
    )
    latest = latest_by_key(log)
    repeated = quality.unique_failures(log, "natural_key")
    for df, partial in ((latest, "partial_max_by"), (repeated, "partial_count")):
        assert partial in plan(df).split("Exchange hashpartitioning")[1]
    assert rows(latest.filter("natural_key = 'hot'")) == [("hot", HOT - 1, "x")]
    assert rows(repeated) == [("hot", HOT)]


def test_requests_and_answers_are_spread_by_their_number(spark):
    """A few bytes of windows and payloads make many rows: they are not merged into one task."""
    from pulseframe.operators import watermarks
    from pulseframe.plans import catalog

    def tasks(df) -> int:
        return df.select(F.spark_partition_id()).distinct().count()

    root = "/root/testdata/sf0.001"
    subjects = spark.range(400).select((F.col("id") % 40).alias("subject_id")).distinct()
    state = spark.createDataFrame([], "subject_id bigint, collector_name string, last_extracted_date date")
    windows = watermarks.fetch_windows(subjects, state, "2024-01-30", "2024-01-01")
    daily, ranged = watermarks.daily_requests(windows), watermarks.range_requests(windows)
    assert tasks(daily) > 1 and daily.count() == 40 * 14 * 30
    answers = catalog._answers(spark, root, catalog._events_of_subjects(spark, root), "2024-01-01")
    assert tasks(answers["range"](ranged)) > 1 and tasks(answers["daily"](daily)) > 1
