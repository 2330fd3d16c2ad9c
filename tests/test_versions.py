"""Versions of a landed table: whatever lands when, no row is lost, and only what changed is read and written."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators import watermarks
from pulseframe.operators.discovery import update_pending
from pulseframe.operators.upsert import LandedTable
from pulseframe.plans.refresh import StoredModel
from pulseframe.plans.runs import full_run
from pulseframe.sources.envelope import parse_rows, stage_rows

T1, T2, T3 = "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"


def batch(spark, items, at=T1, seq=0, strict=True):
    data = [(i, k, p if isinstance(p, str) else json.dumps({"x": p})) for i, (k, p) in enumerate(items)]
    df = spark.createDataFrame(data, "i long, k string, p string")
    staged = stage_rows(df, key=F.col("k"), payload=F.col("p"), source_method="m", extracted_at=at, batch_seq=seq, row_seq=F.col("i"), payload_is_json=True)
    return parse_rows(staged, strict)


def shown(df):
    return rows(df.select("natural_key", paths.as_int(F.col("raw_data"), "$.x")))


def test_a_snapshot_is_built_on_the_one_before(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1)]), 1)
    table.compact(1)
    table.retire(1)
    table.append(batch(spark, [("b", 2)], T2), 2)
    table.compact(2)
    assert shown(table.current()) == shown(table.snapshot(2)) == [("a", 1), ("b", 2)]


def test_a_batch_behind_the_snapshot_is_read(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1)]), 1)
    table.append(batch(spark, [("c", 3)]), 3)
    table.compact(3)
    table.append(batch(spark, [("a", 10), ("b", 2)], T2), 2)
    assert shown(table.current()) == [("a", 10), ("b", 2), ("c", 3)]
    table.compact(4)
    table.retire(4)
    assert shown(table.current()) == [("a", 10), ("b", 2), ("c", 3)]


def test_a_batch_that_lands_again_after_its_snapshot_is_read(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1), ("b", 1)]), 1)
    table.compact(1)
    for _ in range(2):  # the second attempt replaces the first
        table.append(batch(spark, [("b", 2), ("c", 2)]), 1)
        assert shown(table.current()) == [("a", 1), ("b", 2), ("c", 2)]
    table.compact(2)
    table.retire(2)
    table.append(batch(spark, [("c", 3)]), 1)
    assert shown(table.current()) == [("a", 1), ("b", 2), ("c", 3)]
    assert {r for w, n, r in table.batches()} == {0, 1, 2}


def test_versions_that_lack_retired_rows_are_refused(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1)]), 1)
    table.compact(1)
    table.append(batch(spark, [("b", 1)]), 2)
    table.compact(2)
    assert shown(table.current(version=1)) == [("a", 1), ("b", 1)]
    table.retire(2)
    for lost in (lambda: table.current(version=1), lambda: table.compact(5, base_version=1), lambda: table.known_keys(before=2), lambda: table.changes(1)):
        with pytest.raises(ValueError, match="retired"):
            lost()
    with pytest.raises(ValueError, match="versions go up"):
        table.compact(1)
    assert rows(table.changes(1, 2).select("natural_key", "change")) == [("b", "inserted")]


def test_a_compaction_that_died_is_repeated(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1)]), 1)
    left = spark.range(5).selectExpr("id", "'b0' bucket")
    left.write.partitionBy("bucket").parquet(str(tmp_path / "t/snapshot/version=1"))
    assert table.versions() == []
    table.compact(1)
    assert shown(table.current()) == [("a", 1)]


def test_a_batch_that_died_while_it_was_written_is_not_taken_in(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1)]), 1)
    os.makedirs(tmp_path / "t/log/writer=main/batch_seq=2/revision=0/_temporary")
    table.compact(2)
    table.append(batch(spark, [("b", 2)]), 2)
    assert shown(table.current()) == [("a", 1), ("b", 2)]


def test_two_runs_of_one_number_for_other_collectors(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), ("collector_name", "subject_id", "natural_key"), ("collector_name",))
    state = watermarks.StateLog(spark, str(tmp_path / "s"), "subject_id bigint")
    subjects = spark.sql("select 1L subject_id")

    def answer(requests):
        return requests.filter("requested = '2024-02-01'").withColumn("payload", F.lit('{"x":1}'))

    fetch = {"range": lambda r: r.withColumn("payload", F.lit("[]")), "daily": answer}
    for only in ("sleep", "hrv", "sleep"):
        assert full_run(table, state, subjects, fetch, "2024-02-01", "2024-02-01T10:00:00Z", 7, only=only) == {only.upper(): 1}
    assert rows(table.current().select("collector_name", "natural_key")) == [("HRV", "2024-02-01"), ("SLEEP", "2024-02-01")]
    assert rows(state.current().select("collector_name", "last_extracted_date")) == [("HRV", dt.date(2024, 2, 1)), ("SLEEP", dt.date(2024, 2, 1))]


def test_counts_of_staged_rows(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), ("collector_name", "natural_key"), ("collector_name",))
    some = batch(spark, [("a", 1), ("a", 2), ("bad", "{"), ("b", 3)], strict=False).withColumn("collector_name", F.when(F.col("natural_key") == "b", "HRV").otherwise("SLEEP"))
    assert table.append_counted(some, 1, "w", "collector_name", ["HRV", "SLEEP", "STEPS"]) == {"HRV": 1, "SLEEP": 2, "STEPS": 0}
    assert table.append(some, 2) == 3
    for empty in (some.limit(0), some.filter("false"), some.filter("natural_key = 'none'")):
        assert table.append(empty, 3) == 0
        assert table.append_counted(empty, 3, "w", "collector_name", ["HRV"]) == {"HRV": 0}


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def files(root) -> set[str]:
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_read_and_written(spark, tmp_path, whole_plans):
    table = LandedTable(spark, str(tmp_path / "t"), bucket_by="pmod(cast(natural_key as int), 8)")
    table.append(batch(spark, [(str(i), i) for i in range(80)]), 1)
    table.compact(1)
    before = files(tmp_path / "t/snapshot")
    assert {f.split("/")[1] for f in before} == {f"bucket=b{i}" for i in range(8)}
    table.append(batch(spark, [("3", -3), ("11", -11), ("83", 83), ("5", -5)], T2), 2)
    found = table._version(1)
    merged = table._merged(found, table._landed(table._tail(found)))
    filters = [line.split("PartitionFilters")[1].split("]")[0] for line in plan(merged).split("\n") if "PartitionFilters" in line]
    filters = [f for f in filters if "bucket#" in f]
    touched = [f for f in filters if "b3" in f]
    assert touched and all("b5" in f and "b4" not in f for f in touched)
    assert [("b4" in f, "b5" in f) for f in filters if f not in touched] == [(True, False)]  # passed on: read once, met by no join
    table.compact(2)
    new = files(tmp_path / "t/snapshot") - before
    assert before <= files(tmp_path / "t/snapshot") and {f.rsplit("/", 1)[0] for f in new} == {"version=2/bucket=b3", "version=2/bucket=b5"}
    got = dict(shown(table.current()))
    assert len(got) == 81 and [got[k] for k in ("3", "11", "83", "5", "4")] == [-3, -11, 83, -5, 4]
    table.append(batch(spark, []), 3)
    table.compact(3)
    assert files(tmp_path / "t/snapshot") == before | new and dict(shown(table.current())) == got
    table.expire(3)
    assert table.versions() == [3] and dict(shown(table.current())) == got
    gone = (before | new) - files(tmp_path / "t/snapshot")
    assert {f.rsplit("/", 1)[0] for f in gone} == {"version=1/bucket=b3", "version=1/bucket=b5"}


def test_the_first_version_fixes_the_buckets(spark, tmp_path):
    one = LandedTable(spark, str(tmp_path / "t"), bucket_by="length(natural_key)")
    one.append(batch(spark, [("a", 1), ("bb", 1)]), 1)
    one.compact(1)
    other = LandedTable(spark, str(tmp_path / "t"), bucket_by="ascii(natural_key)")
    other.append(batch(spark, [("a", 2), (None, 7)], T2), 2)
    other.compact(2)
    assert shown(one.current()) == [("a", 2), ("bb", 1), (None, 7)]


def test_null_keys_and_empty_tables(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    assert table.current().count() == 0 and table.changes(None).count() == 0
    table.compact(1)
    assert table.current().count() == 0 and table.snapshot(1).count() == 0 and table.known_keys().count() == 0
    table.append(batch(spark, [("a", 1)]), 2)
    assert rows(table.changes(1).select("natural_key", "change")) == [("a", "inserted")]
    table.compact(2)
    assert shown(table.current()) == [("a", 1)]


def test_changes_of_versions_and_since(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", 1), ("b", 1), ("c", 1)], T2), 1)
    table.compact(1)
    table.append(batch(spark, [("a", 2), ("d", 2), ("c", 0)], T1), 2)  # older than what is there
    table.append(batch(spark, [("b", 2), ("e", 2), ("e", 3)], T3), 3)
    want = [("b", 2, "replaced"), ("d", 2, "inserted"), ("e", 3, "inserted")]

    def changes(*span):
        return rows(table.changes(*span).select("natural_key", paths.as_int(F.col("raw_data"), "$.x"), "change"))

    assert changes(1) == want
    table.compact(3)
    table.retire(3)
    assert changes(1, 3) == want and changes(3) == [] and changes(3, 3) == []
    assert [c[2] for c in changes(None, 3)] == ["inserted"] * 5


def test_the_feed_reads_only_new_batches(spark, tmp_path, whole_plans):
    table = LandedTable(spark, str(tmp_path / "t"))
    for n in range(1, 5):
        table.append(batch(spark, [(str(n), n)]), n)
        if n == 2:
            table.compact(2)
    scans = [line for line in plan(table.changes(2)).split("\n") if "PartitionFilters" in line and "/log" in line]
    assert scans and all("IN (3,4)" in s.split("PartitionFilters")[1].split("PushedFilters")[0] for s in scans)
    assert rows(table.changes(2).select("natural_key")) == [("3",), ("4",)]


def test_pending_keeps_up_with_details_before_and_after(spark):
    schema = "collector_name string, natural_key string, change string"
    pending = spark.createDataFrame([], "natural_key string, has_wanted boolean, has_answer boolean")
    steps = [
        ([("A", "1", "inserted"), ("A", "2", "inserted"), ("D", "9", "inserted"), ("X", "1", "inserted")], [("1", True, False), ("2", True, False), ("9", False, True)]),
        ([("D", "1", "inserted"), ("A", "2", "replaced"), ("A", "9", "inserted")], [("2", True, False)]),
        ([("D", "1", "replaced"), ("A", "3", "inserted"), ("D", "3", "inserted")], [("2", True, False)]),
        ([], [("2", True, False)]),
    ]
    for changed, want in steps:
        pending = update_pending(pending, spark.createDataFrame(changed, schema), ("natural_key",), "A", "D")
        assert rows(pending) == want


def test_a_refreshed_model_equals_one_built_anew(spark, tmp_path):
    def build(landed):  # x rows for every key
        n = paths.as_int(F.col("raw_data"), "$.x")
        return landed.select(F.col("natural_key").alias("id"), F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("i")).filter("i > 1")

    table = LandedTable(spark, str(tmp_path / "t"))
    model = StoredModel(str(tmp_path / "m"), ["id"], ["natural_key"], build, buckets=8)
    table.append(batch(spark, [(str(i), 3) for i in range(20)]), 1)
    table.compact(1)
    assert len(model.refresh(table.changes(None, 1))) > 4
    before = files(tmp_path / "m")
    table.append(batch(spark, [("4", 5), ("new", 2), ("7", 1)], T2), 2)
    table.compact(2)
    touched = model.refresh(table.changes(1, 2))
    assert rows(model.read(spark)) == rows(build(table.current()))
    kept = files(tmp_path / "m") & before
    assert {f.split("/")[0] for f in before - kept} <= {f"_bucket={b}" for b in touched} and kept
    assert model.refresh(table.changes(2)) == []
    # A bucket whose last row goes is emptied.
    table.append(batch(spark, [(str(i), 1) for i in range(20)] + [("new", 1)], T3), 3)
    model.refresh(table.changes(2))
    assert model.read(spark).count() == 0 if files(tmp_path / "m") else True
