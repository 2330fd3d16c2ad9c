from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import column, plan, rows
from pyspark.sql import functions as F

from pulseframe.functions import dates
from pulseframe.operators import calendar, quality, samples
from pulseframe.operators.upsert import upsert
from pulseframe.plans import project, staging
from pulseframe.plans.models import import_models, materialize
from pulseframe.session import shared_dir

# Columns of every staging model, in order, without lineage.
COLUMNS = {
    "activities": 20,
    "activity_details": 9,
    "body_battery": 6,
    "body_battery_events": 3,
    "hrv": 8,
    "resting_heart_rate": 3,
    "sleep": 12,
    "steps": 5,
    "training_readiness": 13,
}


def envelope(spark, *items):
    df = spark.createDataFrame([(k, json.dumps(p)) for k, p in items], "natural_key string, j string")
    return df.select(
        "natural_key",
        F.parse_json("j").alias("raw_data"),
        F.expr("timestamp_ntz'2024-02-01 02:00:00'").alias("extracted_at"),
        F.lit("m").alias("source_method"),
    )


@pytest.mark.parametrize("model", sorted(COLUMNS))
def test_every_model_projects_empty_payloads_to_nulls(spark, model):
    payload = [] if model in ("body_battery_events", "training_readiness") else {}
    staged = staging.stage(envelope(spark, ("2024-02-29", payload)), model)
    assert len(staged.columns) == COLUMNS[model] + 2
    assert staged.columns[-2:] == ["extracted_at", "source_method"]
    row = staged.first().asDict()
    filled = {k for k, v in row.items() if v is not None}
    keys = {f.name for f in staging.MODELS[model] if f.kind in ("key", "key_date")}
    counts = {f.name for f in staging.MODELS[model] if f.kind == "array_size" and payload == []}
    assert filled == keys | counts | {"extracted_at", "source_method"}


def test_fallback_keys_cannot_be_dates(spark):
    env = envelope(spark, ("2024-01-01_0", {}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage(env, "steps").collect()


def test_staging_reads_only_the_named_paths(spark, tmp_path):
    path = str(tmp_path / "steps")
    payload = {"stepGoal": 71.5, "totalSteps": "12.6", "totalDistance": 5, "noise": ["x"] * 50}
    envelope(spark, ("2024-01-01", payload)).write.parquet(path)
    staged = staging.stage(spark.read.parquet(path), "steps").select("step_goal", "total_steps")
    assert rows(staged) == [(72, 13)]
    text = plan(staged)
    assert "variant_get" not in text and "raw_data:struct<0:decimal(38,0),1:decimal(38,0)>" in text


def test_current_stage_equals_stage_of_current(spark):
    day1 = envelope(spark, ("2024-01-01", {"totalSteps": 1}), ("2024-01-02", {"totalSteps": 2})).withColumn("batch_seq", F.lit(1))
    day2 = envelope(spark, ("2024-01-02", {"totalSteps": 20})).withColumn("batch_seq", F.lit(2))
    current = staging.stage_current(day1.unionByName(day2), "steps")
    assert rows(current.select("steps_id", "total_steps")) == [("2024-01-01", 1), ("2024-01-02", 20)]


def test_current_stage_shuffles_typed_columns_only(spark, tmp_path):
    path = str(tmp_path / "log")
    log = envelope(spark, ("2024-01-01", {"totalSteps": 1, "noise": ["x"] * 50}))
    log.withColumn("batch_seq", F.lit(1)).write.parquet(path)
    current = staging.stage_current(spark.read.parquet(path), "steps")
    text = plan(current)
    assert "variant_get" not in text and "raw_data:struct<0:" in text
    assert text.count("Exchange") == 1


def test_import_models(spark):
    a, b = spark.range(3), spark.range(4)
    got = import_models([a, b], ["left_side", "right_side"])
    assert got["right_side"].count() == 4
    assert spark.sql("select count(*) from left_side join right_side using (id)").first()[0] == 3
    assert list(import_models(["left_side"], [])) == ["left_side"]
    with pytest.raises(ValueError, match="at least one"):
        import_models([], [])
    with pytest.raises(ValueError, match="same length"):
        import_models([a, b], ["only_one"])


def test_materialize(spark, tmp_path):
    df = spark.range(5)
    assert materialize(df, "a_view").count() == spark.table("a_view").count() == 5
    stored = materialize(df, "a_table", "table", str(tmp_path / "t"))
    assert "FileScan parquet" in plan(stored) and spark.table("a_table").count() == 5
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        materialize(df, "a_table", "table", str(tmp_path / "t"))


def test_an_upsert_on_a_bucketed_table_moves_only_the_batch(spark, tmp_path):
    def landed(ids, seq):
        return ids.select(
            F.col("id").cast("string").alias("natural_key"), F.lit(seq).alias("raw"), F.lit(seq).alias("batch_seq")
        )

    stored = materialize(
        landed(spark.range(200), 1), "landed_buckets", "table", str(tmp_path / "b"), bucket_by=(8, ["natural_key"])
    )
    stored_batch = str(tmp_path / "batch")
    landed(spark.range(150, 250), 2).write.parquet(stored_batch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(stored, spark.read.parquet(stored_batch))
        sides = [part for part in plan(merged).split("SortMergeJoin")[1:]]
        assert len(sides) == 2
        current_side = sides[0].split("Bucketed: true")[0]
        assert "Exchange" not in current_side
        assert rows(merged.groupBy("raw").count()) == [(1, 150), (2, 100)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def day(spark, text):
    spine = spark.sql(f"select date'{text}' as date_day")
    return calendar.dim_dates(spine, F.lit("2024-02-29").cast("date")).first()


def test_leap_day(spark):
    r = day(spark, "2024-02-29")
    assert r.prior_year_date_day == dt.date(2023, 2, 28)
    assert r.prior_year_over_year_date_day == dt.date(2023, 3, 2)
    assert r.is_last_day_of_month and r.is_current_date and not r.is_weekend
    assert (r.day_of_week, r.day_of_week_iso, r.day_of_week_name, r.month_name_short) == (5, 4, "Thursday", "Feb")
    assert (r.week_start_date, r.week_end_date) == (dt.date(2024, 2, 25), dt.date(2024, 3, 2))
    assert (r.quarter_start_date, r.quarter_end_date) == (dt.date(2024, 1, 1), dt.date(2024, 3, 31))


def test_new_year_on_a_sunday(spark):
    r = day(spark, "2023-01-01")
    assert (r.week_of_year, r.day_of_week, r.day_of_week_iso, r.is_weekend) == (52, 1, 7, True)
    assert r.week_start_date == dt.date(2023, 1, 1) and r.is_first_day_of_month
    assert (r.year_start_date, r.year_end_date) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))


def test_dimension_shape_and_bounds(spark):
    bounds = calendar.default_bounds(spark, "2024-02-29")
    dim = calendar.dim_dates(calendar.date_spine(bounds), F.lit("2024-02-29").cast("date"))
    assert len(dim.columns) == 29
    first, last, n = dim.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert (first, last) == (dt.date(2020, 1, 1), dt.date(2025, 2, 27)) and n == (last - first).days + 1
    assert calendar.date_spine(bounds, end_inclusive=True).count() == n + 1
    assert dim.filter("is_current_date").count() == 1


def test_today_follows_the_zone_not_the_session(spark):
    zones = ["Pacific/Kiritimati", "Pacific/Pago_Pago"]  # 25 hours apart: never the same day
    row = spark.range(1).select(*[dates.today_in(z).alias(f"z{i}") for i, z in enumerate(zones)]).first()
    assert (row.z0 - row.z1).days in (1, 2)


def test_inverted_bounds_give_no_days(spark):
    bounds = spark.sql("select date'2024-01-02' start_date, date'2024-01-01' end_date")
    assert calendar.date_spine(bounds).count() == 0


def test_gap_days(spark):
    d = dt.date
    facts = spark.createDataFrame([("a", d(2024, 1, 1)), ("a", d(2024, 1, 4)), ("a", d(2024, 1, 4)), ("b", d(2024, 1, 9))], "u string, day date")
    assert rows(calendar.gap_days(facts, ["u"], "day")) == [("a", d(2024, 1, 2)), ("a", d(2024, 1, 3))]


def test_data_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert rows(quality.unique_failures(df, "k")) == [(1, 2)]
    assert column(quality.not_null_failures(df, "k"), "v") == ["c", "d"]
    report = quality.data_test_report({"m": (df, ["k"]), "empty": (df.limit(0), ["k"])})
    assert rows(report) == [
        ("empty", "k", "not_null", 0, 0),
        ("empty", "k", "unique", 0, 0),
        ("m", "k", "not_null", 5, 2),
        ("m", "k", "unique", 5, 1),
    ]


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(f"{root}/x-") and a != b


def test_published_project(spark, tmp_path):
    activity = {
        "metricDescriptors": [{"metricsIndex": 0, "key": "directLatitude", "unit": {"key": "dd"}}],
        "activityDetailMetrics": [{"metrics": [1.5]}, {"metrics": [2.5]}],
    }
    landed = {
        "steps": envelope(spark, ("2024-01-01", {"totalSteps": 5}), ("2024-01-02", {"totalSteps": 6})),
        "activity_details": envelope(spark, ("a", activity)),
    }
    stored = str(tmp_path / "series")
    samples.series_from_envelope(landed["activity_details"]).write.parquet(stored)
    bounds = calendar.default_bounds(spark, "2024-02-29")
    models = project.build_models(landed, bounds, F.lit("2024-02-29").cast("date"), series=spark.read.parquet(stored))
    assert set(models) == {"stg_steps", "stg_activity_details", *project.DERIVED_KEYS}
    published = project.publish(models, str(tmp_path / "marts"), rename=lambda name: f"proj_{name}")
    assert "FileScan" in plan(published["proj_dim_dates"])
    got = spark.sql(
        "select sum(total_steps) from proj_stg_steps join proj_dim_dates on steps_date = date_day where not is_weekend"
    )
    assert got.first()[0] == 11
    assert spark.table("proj_int_activities_gps_samples_pivoted").count() == 2
    report = project.test_models(models)
    assert report.count() == 14 and report.filter("failures > 0").count() == 0
