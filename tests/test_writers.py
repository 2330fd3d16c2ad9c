"""Landed rows never vanish, whoever else writes to the table."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from pulseframe.operators import samples, watermarks
from pulseframe.operators.upsert import LandedTable, existing_keys
from pulseframe.plans.runs import details_to_fetch, land_details, land_new_activities, land_run
from pulseframe.sources.envelope import parse_rows, stage_rows
from pulseframe.streaming.landing import land_stream, payload_stream

KEYS = ("collector_name", "subject_id", "natural_key")
AT = "2024-02-01T10:00:00Z"


def landed(table):
    return rows(table.current().select(*KEYS))


def feed(spark, *items):
    data = [(s, str(i), p, json.dumps({"id": i})) for s, i, p in items]
    return spark.createDataFrame(data, "subject_id long, natural_key string, pos long, payload string")


def sleep(spark, subject, day):
    data = [("SLEEP", subject, dt.date.fromisoformat(day), '{"x":1}', "m")]
    return spark.createDataFrame(data, "collector_name string, subject_id long, requested date, payload string, source_method string")


def collect(spark, table, state, run_seq):
    windows = watermarks.fetch_windows(spark.sql("select 1L subject_id"), state.current(before=run_seq), "2024-02-01", only="sleep")
    daily = sleep(spark, 1, "2024-01-31")
    land_run(table, state, windows, daily.limit(0).withColumnRenamed("requested", "chunk_start"), daily, "2024-02-01", AT, run_seq)


def stream(spark, table, inbox, checkpoint):
    def to_rows(batch, batch_seq):
        staged = stage_rows(
            batch.withColumn("collector_name", F.lit("STREAMED")), key=F.col("k"), payload=F.struct("x"), source_method="m", extracted_at=AT, batch_seq=batch_seq
        )
        return parse_rows(staged)

    source = payload_stream(spark, str(inbox), "subject_id long, k string, x int")
    land_stream(source, to_rows, table, str(checkpoint)).awaitTermination()


def put(inbox, name, subject, key):
    inbox.mkdir(exist_ok=True)
    (inbox / name).write_text(json.dumps({"subject_id": subject, "k": key, "x": 1}) + "\n")


def test_one_run_number_for_collectors_activities_and_details(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), KEYS, ("collector_name",))
    state = watermarks.StateLog(spark, str(tmp_path / "s"), "subject_id bigint")
    want = [("ACTIVITIES", 1, "7"), ("ACTIVITY_DETAILS", 1, "7"), ("SLEEP", 1, "2024-01-31")]
    for _ in range(2):  # the retry lands the same rows
        collect(spark, table, state, 7)
        land_new_activities(table, feed(spark, (1, 7, 7)), "pos", AT, 7)
        land_details(table, feed(spark, (1, 7, 7)), AT, 7)
        assert landed(table) == want


def test_two_streams_and_a_run_on_one_table(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), KEYS, ("collector_name",))
    state = watermarks.StateLog(spark, str(tmp_path / "s"), "subject_id bigint")
    a, b = tmp_path / "a", tmp_path / "b"
    put(a, "1.json", 1, "a1")
    put(b, "1.json", 1, "b1")
    stream(spark, table, a, tmp_path / "ca")
    stream(spark, table, b, tmp_path / "cb")
    collect(spark, table, state, 0)  # the number of the streams' first batch
    want = [("SLEEP", 1, "2024-01-31"), ("STREAMED", 1, "a1"), ("STREAMED", 1, "b1")]
    assert landed(table) == want
    table.compact(5)
    put(b, "2.json", 2, "b2")  # batch 1 of its stream lands after snapshot 5
    stream(spark, table, b, tmp_path / "cb")
    collect(spark, table, state, 0)
    want = sorted([*want, ("STREAMED", 2, "b2")])
    assert landed(table) == want
    assert rows(table.current(version=5).select(*KEYS)) == want
    table.compact(6, base_version=5)
    assert rows(table.snapshot(6).select(*KEYS)) == want


def test_names_of_writers_are_folder_names(spark, tmp_path):
    with pytest.raises(ValueError):
        LandedTable(spark, str(tmp_path / "t")).append(spark.range(1), 1, "a/b=c")


def test_each_subject_has_its_own_cut_and_ids(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), KEYS, ("collector_name",))
    land_new_activities(table, feed(spark, (1, 100, 10)), "pos", AT, 1)
    land_new_activities(table, feed(spark, (2, 50, 1), (2, 51, 2), (2, 100, 3), (1, 101, 11), (1, 100, 10), (1, 99, 9)), "pos", AT, 2)
    got = [(s, k) for _, s, k in landed(table)]
    assert got == [(1, "100"), (1, "101"), (2, "100"), (2, "50"), (2, "51")]
    land_details(table, feed(spark, (1, 100, 10)), AT, 3)
    missing = details_to_fetch(table)
    assert missing.columns == ["subject_id", "natural_key"]
    assert rows(missing) == [(1, "101"), (2, "100"), (2, "50"), (2, "51")]


def test_an_empty_table_has_the_types_of_a_filled_one(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "none"), KEYS)
    assert dict(existing_keys(table.log(), KEYS).dtypes)["subject_id"] == "bigint"


def test_positions_are_rounded_like_other_integers(spark):
    payload = '{"metricDescriptors":[{"metricsIndex":0.6,"key":"a"},{"metricsIndex":"1.6","key":"b"}],"activityDetailMetrics":[{"metrics":[1,2,3]}]}'
    details = spark.sql("select 'x' natural_key").withColumn("raw_data", F.parse_json(F.lit(payload)))
    long = samples.unpivot(samples.series_from_envelope(details))
    assert rows(long.select("metric_key", "metric_value")) == [("a", 2.0), ("b", 3.0)]
