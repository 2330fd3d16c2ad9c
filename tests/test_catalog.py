from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
import check_oracles
from helpers import rows
from pulseframe.plans.catalog import QUERIES
from pulseframe.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    assert check_oracles.compare(spark, con, name, sf) is None


def test_stream_reads_a_table_stored_as_a_folder(spark, sf, tmp_path):
    """As tables are on a cluster: many files, taken in several micro-batches."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(30).write.parquet(str(tmp_path / "events.parquet"))
    query = entry_point.queries()["stream_land"]
    assert rows(query(spark, str(tmp_path))) == rows(query(spark, sf))


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["activity_id", "minute", "num_samples", "avg_heart_rate", "max_heart_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
@pytest.mark.parametrize("name", ["stg_activities", "stg_sleep", "stg_hrv", "cardio_pivot", "land_envelope", "watermark_advance"])
def test_results_do_not_depend_on_the_session_zone(spark, con, sf, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert check_oracles.compare(spark, con, name, sf) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
