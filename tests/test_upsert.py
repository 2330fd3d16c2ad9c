from __future__ import annotations

import json

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators.upsert import LandedTable, existing_keys, latest_by_key, upsert
from pulseframe.sources.envelope import parse_rows, read_or_empty, split_rejected, stage_rows


def batch(spark, items, at, seq, strict=True):
    """``items`` are (key, payload object or raw text), in list order."""
    data = [(i, k, p if isinstance(p, str) else json.dumps(p)) for i, (k, p) in enumerate(items)]
    df = spark.createDataFrame(data, "i long, k string, p string")
    staged = stage_rows(
        df,
        key=F.col("k"),
        payload=F.col("p"),
        source_method="m",
        extracted_at=at,
        batch_seq=seq,
        row_seq=F.col("i"),
        payload_is_json=True,
    )
    return parse_rows(staged, strict)


def shown(df):
    return rows(df.select("natural_key", paths.as_int(F.col("raw_data"), "$.x"), "source_method"))


T1, T2, T3 = "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"


def test_replace_insert_and_last_of_a_batch(spark):
    b1 = batch(spark, [("a", {"x": 1}), ("b", {"x": 2}), ("a", {"x": 3})], T1, 1)
    b2 = batch(spark, [("b", {"x": 20}), ("c", {"x": 30})], T2, 2)
    want = [("a", 3, "m"), ("b", 20, "m"), ("c", 30, "m")]
    assert shown(latest_by_key(b1.unionByName(b2))) == want
    assert shown(upsert(latest_by_key(b1), b2)) == want


def test_replay_and_late_arrival_change_nothing(spark):
    b1 = batch(spark, [("a", {"x": 1}), ("b", {"x": 2})], T1, 1)
    b2 = batch(spark, [("a", {"x": 10})], T2, 2)
    current = upsert(latest_by_key(b1), b2)
    want = [("a", 10, "m"), ("b", 2, "m")]
    assert shown(upsert(current, b2)) == want
    assert shown(upsert(current, b1)) == want
    assert shown(upsert(latest_by_key(b2), b1)) == want


def test_empty_batch(spark):
    b1 = batch(spark, [("a", {"x": 1})], T1, 1)
    assert shown(upsert(b1, b1.limit(0))) == [("a", 1, "m")]
    assert shown(upsert(b1.limit(0), b1)) == [("a", 1, "m")]


def test_same_time_is_ordered_by_batch(spark):
    b1, b2 = batch(spark, [("a", {"x": 1})], T1, 1), batch(spark, [("a", {"x": 2})], T1, 2)
    assert shown(upsert(b2, b1)) == [("a", 2, "m")]
    assert shown(upsert(b1, b2)) == [("a", 2, "m")]


def test_ties_without_row_order_are_decided_by_content(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "k string, x int")

    def land(frame):
        return parse_rows(
            stage_rows(frame, key=F.col("k"), payload=F.struct("x"), source_method="m", extracted_at=T1)
        )

    assert shown(latest_by_key(land(df.repartition(3)))) == shown(latest_by_key(land(df.orderBy(F.desc("x")))))


def test_staged_payloads_are_json_with_iso_dates(spark):
    df = spark.sql("select 7 k, date'2024-01-02' d, cast(null as int) n")
    staged = stage_rows(df, key=F.col("k"), payload=F.struct("d", "n"), source_method="m", extracted_at=T1)
    row = staged.first()
    assert (row.natural_key, row.raw_text) == ("7", '{"d":"2024-01-02"}')


def test_strict_parsing_fails_and_lenient_parsing_quarantines(spark):
    items = [("good", {"x": 1}), ("broken", '{"x":'), ("twice", '{"x":1,"x":2}'), ("null", "null")]
    with pytest.raises(Exception, match="MALFORMED_RECORD|VARIANT_DUPLICATE_KEY"):
        batch(spark, items, T1, 1).collect()
    good, bad = split_rejected(batch(spark, items, T1, 1, strict=False))
    assert [r[0] for r in rows(good.select("natural_key"))] == ["good", "null"]
    assert rows(bad.select("natural_key", "rejected_text")) == [("broken", '{"x":'), ("twice", '{"x":1,"x":2}')]


def test_missing_table_has_no_keys(spark, tmp_path):
    assert existing_keys(read_or_empty(spark, str(tmp_path / "none"))).count() == 0
    table = LandedTable(spark, str(tmp_path / "none"), ("subject_id", "natural_key"))
    assert existing_keys(table.log(), table.keys).count() == 0 and table.quarantine().count() == 0


def test_landed_table_round_trip(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", {"x": 1}), ("b", {"x": 2})], T1, 1), 1)
    table.append(batch(spark, [("b", {"x": 20}), ("bad", "{")], T2, 2, strict=False), 2)
    table.append(batch(spark, [("b", {"x": 20}), ("bad", "{")], T2, 2, strict=False), 2)  # retry
    assert shown(table.current()) == [("a", 1, "m"), ("b", 20, "m")]
    assert rows(table.quarantine().select("natural_key", "rejected_text")) == [("bad", "{")]
    table.compact(2)
    table.append(batch(spark, [("a", {"x": 100}), ("c", {"x": 3})], T3, 3), 3)
    want = [("a", 100, "m"), ("b", 20, "m"), ("c", 3, "m")]
    assert shown(table.current()) == shown(table.current(version=2)) == want
    table.compact(3, base_version=2)
    assert shown(table.snapshot(3)) == want
    assert shown(table.snapshot(2)) == [("a", 1, "m"), ("b", 20, "m")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.compact(3)


def test_one_log_for_many_collectors(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), ("collector_name", "natural_key"), ("collector_name",))
    for seq, name in ((1, "STEPS"), (2, "SLEEP")):
        rows_ = batch(spark, [("2024-01-01", {"x": seq})], T1, seq)
        table.append(rows_.withColumn("collector_name", F.lit(name)), seq)
    steps = table.log().filter("collector_name = 'STEPS'")
    assert shown(latest_by_key(steps, table.keys)) == [("2024-01-01", 1, "m")]
    assert "collector_name" in plan(steps).split("PartitionFilters")[1].split("]")[0]


def test_a_small_stored_batch_leaves_the_snapshot_in_place(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    big = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("x"))
    table.append(
        parse_rows(stage_rows(big, key=F.col("k"), payload=F.struct("x"), source_method="m", extracted_at=T1)), 1
    )
    table.compact(1)
    table.append(batch(spark, [("1", {"x": -1}), ("new", {"x": 5})], T2, 2), 2)
    merged = table.current(version=1)
    text = plan(merged)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    # The only hash exchange is the batch's own deduplication.
    for line in text.split("Union")[1].split("BroadcastHashJoin")[1:2]:
        assert "hashpartitioning" not in line.split("BroadcastExchange")[0]
    assert merged.count() == 5001


def test_retired_batches_live_on_in_the_snapshot(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    assert table.newest_version() is None and table.known_keys().count() == 0
    table.append(batch(spark, [("a", {"x": 1}), ("b", {"x": 2}), ("bad", "{")], T1, 1, strict=False), 1)
    table.append(batch(spark, [("b", {"x": 20})], T2, 2), 2, "other")
    table.compact(2)
    table.retire(2)
    assert table.log().count() == 0 and rows(table.quarantine().select("natural_key")) == [("bad",)]
    assert shown(table.current()) == [("a", 1, "m"), ("b", 20, "m")]
    table.append(batch(spark, [("a", {"x": 3}), ("c", {"x": 4})], T3, 3), 3)
    want = [("a", 3, "m"), ("b", 20, "m"), ("c", 4, "m")]
    assert table.newest_version() == 2 and shown(table.current()) == want
    assert rows(table.known_keys()) == [("a",), ("b",), ("c",)] and rows(table.known_keys(before=3)) == [("a",), ("b",)]
    table.compact(3, base_version=2)
    table.retire(3)
    assert shown(table.current()) == want and (table.newest_version(), table.newest_version(before=3)) == (3, 2)


def test_a_late_batch_does_not_replace_what_the_snapshot_has(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", {"x": 2}), ("b", {"x": 2})], T2, 2), 2)
    table.compact(2)
    table.append(batch(spark, [("a", {"x": 1}), ("c", {"x": 1})], T1, 1), 1, "late")
    assert shown(table.current()) == [("a", 2, "m"), ("b", 2, "m"), ("c", 1, "m")]
