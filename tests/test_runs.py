from __future__ import annotations

import datetime as dt
import json

from helpers import column, rows
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators import watermarks
from pulseframe.operators.upsert import LandedTable
from pulseframe.plans.runs import details_to_fetch, land_details, land_new_activities, land_run

KEYS = ("collector_name", "natural_key")


def fetched(spark, field, *items):
    data = [(c, dt.date.fromisoformat(d), p if isinstance(p, str) else json.dumps(p)) for c, d, p in items]
    return spark.createDataFrame(data, f"collector_name string, {field} date, payload string").withColumn(
        "source_method", F.lit("m")
    )


def test_a_run_that_died_half_way_is_repeated(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), KEYS, ("collector_name",))
    state = watermarks.StateLog(spark, str(tmp_path / "s"))
    nobody = spark.range(1).select()

    def run(day, seq, daily, ranged, state_log):
        windows = watermarks.fetch_windows(nobody, state.current(before=seq), day, only="sleep,steps")
        starts = {r.collector_name: r.start_date.isoformat() for r in windows.collect()}
        land_run(
            table,
            state_log,
            windows,
            fetched(spark, "chunk_start", *ranged),
            fetched(spark, "requested", *daily),
            day,
            f"{day}T10:00:00Z",
            seq,
        )
        return starts

    class Dies(watermarks.StateLog):
        def append(self, *args):
            raise RuntimeError("lost")

    first = (
        "2024-02-01",
        1,
        [("SLEEP", "2024-01-31", {"x": 1}), ("SLEEP", "2024-02-01", "{cut")],
        [("STEPS", "2024-01-02", [{"calendarDate": "2024-01-30", "x": 3}])],
    )
    try:
        run(*first, Dies(spark, str(tmp_path / "s")))
    except RuntimeError:
        pass
    assert state.current().count() == 0
    assert run(*first, state) == {"SLEEP": "2024-01-02", "STEPS": "2024-01-02"}
    again = run("2024-02-03", 2, [("SLEEP", "2024-01-31", {"x": 10}), ("SLEEP", "2024-02-01", {"x": 2})], [], state)
    assert again == {"SLEEP": "2024-01-29", "STEPS": "2024-01-29"}
    # Repeating a finished run plans the same windows and changes nothing.
    assert again == run("2024-02-03", 2, [("SLEEP", "2024-01-31", {"x": 10}), ("SLEEP", "2024-02-01", {"x": 2})], [], state)
    got = table.current().select(*KEYS, paths.as_int("raw_data", "$.x"))
    assert rows(got) == [("SLEEP", "2024-01-31", 10), ("SLEEP", "2024-02-01", 2), ("STEPS", "2024-01-30", 3)]
    assert rows(table.quarantine().select(*KEYS)) == [("SLEEP", "2024-02-01")]
    assert column(state.current(), "last_extracted_date") == [dt.date(2024, 2, 3)] * 2


def test_activities_then_details(spark, tmp_path):
    table = LandedTable(spark, str(tmp_path / "t"), KEYS, ("collector_name",))

    def feed(*ids):
        data = [(str(i), i, json.dumps({"activityId": i})) for i in ids]
        return spark.createDataFrame(data, "natural_key string, pos long, payload string")

    def landed():
        return column(table.current().filter("collector_name = 'ACTIVITIES'"), "natural_key")

    assert details_to_fetch(table).count() == 0
    land_new_activities(table, feed(3, 2, 1), "pos", "2024-01-01T00:00:00Z", 1)
    # 4 is older than a known one by position, so it is never reached.
    late = feed(6, 5, 3).unionByName(feed(4).withColumn("pos", F.lit(2)))
    for _ in range(2):  # the retry lands the same rows
        land_new_activities(table, late, "pos", "2024-01-02T00:00:00Z", 2)
        assert landed() == ["1", "2", "3", "5", "6"]
    answers = spark.createDataFrame([("1", "{}"), ("2", "{bad"), ("3", '{"metricsCount":0}'), ("5", "null")], "natural_key string, payload string")
    land_details(table, answers, "2024-01-02T01:00:00Z", 3)
    assert column(details_to_fetch(table), "natural_key") == ["1", "2", "5", "6"]
    assert column(details_to_fetch(table, before=3), "natural_key") == ["1", "2", "3", "5", "6"]
    assert rows(table.quarantine().select("natural_key", "rejected_text")) == [("2", "{bad")]
