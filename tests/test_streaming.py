from __future__ import annotations

import json

from helpers import rows
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators import normalize
from pulseframe.operators.upsert import LandedTable
from pulseframe.sources.envelope import to_envelope
from pulseframe.sources.files import RANGE_FOLDERS, payload_files
from pulseframe.streaming.landing import land_stream, payload_stream

SCHEMA = "requested date, payload string"


def write(folder, name, *items):
    text = "\n".join(json.dumps({"requested": d, "payload": p if isinstance(p, str) else json.dumps(p)}) for d, p in items)
    (folder / name).write_text(text + "\n")


def test_files_are_landed_once_and_late_values_win(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    table = LandedTable(spark, str(tmp_path / "table"))

    def to_rows(batch, batch_seq):
        fetched = batch.withColumn("source_method", F.lit("m"))
        rows_ = normalize.normalize_daily(fetched, strict=False).withColumn(
            "extracted_at", F.lit("2024-01-01").cast("timestamp_ntz")
        )
        return to_envelope(rows_, extracted_at=F.col("extracted_at"), batch_seq=batch_seq)

    def run():
        stream = payload_stream(spark, str(inbox), SCHEMA, files_per_batch=1)
        query = land_stream(stream, to_rows, table, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return query.lastProgress

    write(inbox, "1.json", ("2024-01-01", {"x": 1}), ("2024-01-02", {"x": 2}), ("2024-01-03", "{}"), ("2024-01-04", "{bad"))
    run()
    value = paths.as_int("raw_data", "$.x")
    assert rows(table.current().select("natural_key", value)) == [("2024-01-01", 1), ("2024-01-02", 2)]
    assert rows(table.quarantine().select("natural_key")) == [("2024-01-04",)]

    write(inbox, "2.json", ("2024-01-02", {"x": 20}), ("2024-01-05", {"x": 5}))
    run()
    run()  # nothing new
    want = [("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-05", 5)]
    assert rows(table.current().select("natural_key", value)) == want
    assert table.log().count() == 4


def document(root, folder, payload):
    (root / folder).mkdir(parents=True)
    text = payload if isinstance(payload, str) else json.dumps(payload, indent=2)
    (root / folder / "part.json").write_text(text)


def test_documents_in_request_folders(spark, tmp_path):
    daily, ranged = tmp_path / "daily", tmp_path / "range"
    document(daily, "collector_name=SLEEP/requested=2024-01-05", {"dailySleepDTO": {"retro": True}})
    document(daily, "collector_name=HRV/requested=2024-01-05", {})
    document(daily, "collector_name=HRV/requested=2024-01-06", "{cut")
    document(ranged, "collector_name=STEPS/chunk_start=2024-01-01", [{"calendarDate": "2024-01-01"}, {"x": 1}])
    files = payload_files(spark, str(daily))
    landed = normalize.normalize_daily(files, strict=False)
    assert rows(landed.select("collector_name", "natural_key", "source_method", "rejected_text")) == [
        ("HRV", "2024-01-06", "get_hrv_data", "{cut"),
        ("SLEEP", "2024-01-05", "get_sleep_data", None),
    ]
    steps = normalize.normalize_range(payload_files(spark, str(ranged), RANGE_FOLDERS))
    assert rows(steps.select("collector_name", "natural_key")) == [("STEPS", "2024-01-01"), ("STEPS", "2024-01-01_1")]

    keys = ("collector_name", "natural_key")
    table = LandedTable(spark, str(tmp_path / "table"), keys, ("collector_name",))

    def to_rows(batch, batch_seq):
        normal = normalize.normalize_daily(batch, strict=False)
        return to_envelope(normal, extracted_at="2024-02-01T00:00:00Z", batch_seq=batch_seq)

    stream = payload_files(spark, str(daily), stream=True)
    land_stream(stream, to_rows, table, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(table.current().select(*keys)) == [("SLEEP", "2024-01-05")]
    assert rows(table.quarantine().select(*keys)) == [("HRV", "2024-01-06")]


def test_a_replayed_micro_batch_replaces_itself(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "table"))
    day = spark.sql("select date'2024-01-01' requested, '{\"x\":1}' payload, 'm' source_method")
    landed = to_envelope(normalize.normalize_daily(day), extracted_at="2024-01-01T00:00:00Z", batch_seq=0)
    for _ in range(3):
        table.append(landed, 0)
    assert table.log().count() == 1
