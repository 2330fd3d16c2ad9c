"""Staging models as data: a column list per landed table, and one projector.

A model is a narrow 1:1 projection of an envelope table. Over VARIANT Parquet
the named paths become scan columns, so only they are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators.upsert import latest_by_key
from pulseframe.sources.envelope import ORDER_COLUMNS, context_columns


class Field(NamedTuple):
    name: str
    kind: str
    path: str = "$"


_READERS = {
    "string": paths.as_string,
    "int": paths.as_int,
    "float": paths.as_float,
    "boolean": paths.as_boolean,
    "date": paths.as_date,
    "epoch_ms": paths.epoch_ms_to_ntz,
    "array_size": paths.array_size,
    "variant": paths.as_variant,
}

# Column name, type, payload path of every staging model.
MODELS: dict[str, list[Field]] = {
    "activities": [
        Field("activity_id", "key"),
        Field("device_id", "string", "$.deviceId"),
        Field("activity_name", "string", "$.activityName"),
        Field("activity_type", "string", "$.activityType.typeKey"),
        Field("event_type", "string", "$.eventType.typeKey"),
        Field("location_name", "string", "$.locationName"),
        Field("distance_meters", "float", "$.distance"),
        Field("duration_seconds", "float", "$.duration"),
        Field("elapsed_duration_seconds", "float", "$.elapsedDuration"),
        Field("moving_duration_seconds", "float", "$.movingDuration"),
        Field("calories", "int", "$.calories"),
        Field("average_heart_rate", "int", "$.averageHR"),
        Field("max_heart_rate", "int", "$.maxHR"),
        Field("average_speed_mps", "float", "$.averageSpeed"),
        Field("max_speed_mps", "float", "$.maxSpeed"),
        Field("elevation_gain_meters", "float", "$.elevationGain"),
        Field("elevation_loss_meters", "float", "$.elevationLoss"),
        Field("is_favorite", "boolean", "$.favorite"),
        Field("activity_date", "date", "$.startTimeLocal"),
        Field("started_at", "local_timestamp", "$.startTimeLocal"),
    ],
    "activity_details": [
        Field("activity_id", "key"),
        Field("measurement_count", "int", "$.measurementCount"),
        Field("metrics_count", "int", "$.metricsCount"),
        Field("total_metrics_count", "int", "$.totalMetricsCount"),
        Field("num_samples", "array_size", "$.activityDetailMetrics"),
        Field("has_pending_data", "boolean", "$.pendingData"),
        Field("is_details_available", "boolean", "$.detailsAvailable"),
        Field("metric_descriptors", "variant", "$.metricDescriptors"),
        Field("activity_detail_metrics", "variant", "$.activityDetailMetrics"),
    ],
    "body_battery": [
        Field("body_battery_id", "key"),
        Field("charged_points", "int", "$.charged"),
        Field("drained_points", "int", "$.drained"),
        Field("body_battery_date", "key_date"),
        Field("started_at", "local_timestamp", "$.startTimestampLocal"),
        Field("ended_at", "local_timestamp", "$.endTimestampLocal"),
    ],
    "body_battery_events": [
        Field("body_battery_event_id", "key"),
        Field("num_events", "array_size"),
        Field("body_battery_event_date", "key_date"),
    ],
    "hrv": [
        Field("hrv_id", "key"),
        Field("hrv_status", "string", "$.hrvSummary.status"),
        Field("last_night_avg_hrv", "int", "$.hrvSummary.lastNightAvg"),
        Field("weekly_avg_hrv", "int", "$.hrvSummary.weeklyAvg"),
        Field("last_night_5min_high_hrv", "int", "$.hrvSummary.lastNight5MinHigh"),
        Field("hrv_date", "key_date"),
        Field("started_at", "local_timestamp", "$.startTimestampLocal"),
        Field("ended_at", "local_timestamp", "$.endTimestampLocal"),
    ],
    "resting_heart_rate": [
        Field("resting_heart_rate_id", "key"),
        Field("resting_heart_rate", "int", "$.allMetrics.metricsMap.WELLNESS_RESTING_HEART_RATE[0].value"),
        Field("resting_heart_rate_date", "key_date"),
    ],
    "sleep": [
        Field("sleep_id", "key"),
        Field("sleep_time_seconds", "int", "$.dailySleepDTO.sleepTimeSeconds"),
        Field("deep_sleep_seconds", "int", "$.dailySleepDTO.deepSleepSeconds"),
        Field("light_sleep_seconds", "int", "$.dailySleepDTO.lightSleepSeconds"),
        Field("rem_sleep_seconds", "int", "$.dailySleepDTO.remSleepSeconds"),
        Field("awake_sleep_seconds", "int", "$.dailySleepDTO.awakeSleepSeconds"),
        Field("nap_time_seconds", "int", "$.dailySleepDTO.napTimeSeconds"),
        Field("is_retro", "boolean", "$.dailySleepDTO.retro"),
        Field("is_sleep_window_confirmed", "boolean", "$.dailySleepDTO.sleepWindowConfirmed"),
        Field("sleep_date", "key_date"),
        Field("sleep_started_at", "epoch_ms", "$.dailySleepDTO.sleepStartTimestampLocal"),
        Field("sleep_ended_at", "epoch_ms", "$.dailySleepDTO.sleepEndTimestampLocal"),
    ],
    "steps": [
        Field("steps_id", "key"),
        Field("step_goal", "int", "$.stepGoal"),
        Field("total_distance_meters", "float", "$.totalDistance"),
        Field("total_steps", "int", "$.totalSteps"),
        Field("steps_date", "key_date"),
    ],
    # The payload lists the day's snapshots, newest first.
    "training_readiness": [
        Field("training_readiness_id", "key"),
        Field("readiness_level", "string", "$[0].level"),
        Field("feedback_short", "string", "$[0].feedbackShort"),
        Field("feedback_long", "string", "$[0].feedbackLong"),
        Field("readiness_score", "int", "$[0].score"),
        Field("acute_load", "int", "$[0].acuteLoad"),
        Field("recovery_time_minutes", "int", "$[0].recoveryTime"),
        Field("sleep_score", "int", "$[0].sleepScore"),
        Field("hrv_weekly_average", "int", "$[0].hrvWeeklyAverage"),
        Field("num_readiness_snapshots", "array_size"),
        Field("is_valid_sleep", "boolean", "$[0].validSleep"),
        Field("training_readiness_date", "key_date"),
        Field("recorded_at", "local_timestamp", "$[0].timestampLocal"),
    ],
}

LINEAGE = ("extracted_at", "source_method")


def _column(field: Field, zone: str | None) -> Column:
    if field.kind == "key":
        return F.col("natural_key")
    if field.kind == "key_date":
        return F.col("natural_key").cast("date")
    raw = F.col("raw_data")
    if field.kind == "local_timestamp":
        return paths.as_local_timestamp(raw, field.path, zone)
    return _READERS[field.kind](raw, field.path)


def stage(envelope: DataFrame, model: str, zone: str | None = None) -> DataFrame:
    """Typed projection of a landed table; ``zone`` is where zone-less local text was written."""
    return envelope.select(
        *context_columns(envelope),
        *[_column(f, zone).alias(f.name) for f in MODELS[model]],
        *LINEAGE,
    )


def stage_current(log: DataFrame, model: str, zone: str | None = None) -> DataFrame:
    """Staging model of the latest row per key, straight from a log of batches.

    Staging is row by row, so it runs *before* rows compete: the scan reads only
    the named paths and the shuffle carries typed columns, not payloads.
    """
    staged = stage(log, model, zone)
    order = [c for c in ORDER_COLUMNS if c in log.columns]
    hidden = {c: f"_{c}" for c in order}
    typed = log.select(
        *context_columns(log),
        *[_column(f, zone).alias(f.name) for f in MODELS[model]],
        *LINEAGE,
        *[F.col(c).alias(alias) for c, alias in hidden.items()],
    )
    keys = [*context_columns(log), primary_key(model)]
    return latest_by_key(typed, keys, list(hidden.values())).select(*staged.columns)


def primary_key(model: str) -> str:
    return next(f.name for f in MODELS[model] if f.kind == "key")
