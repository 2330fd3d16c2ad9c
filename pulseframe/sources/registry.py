"""The collectors a run may fetch, as data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Landed table, source method.
RANGE_METHODS = {
    "STEPS": "get_daily_steps",
    "BODY_BATTERY": "get_body_battery",
    "BODY_COMPOSITION": "get_body_composition",
    "WEIGH_INS": "get_weigh_ins",
    "ENDURANCE_SCORE": "get_endurance_score",
    "HILL_SCORE": "get_hill_score",
}
DAILY_METHODS = {
    "STATS": "get_stats",
    "RESTING_HEART_RATE": "get_rhr_day",
    "SLEEP": "get_sleep_data",
    "HRV": "get_hrv_data",
    "BODY_BATTERY_EVENTS": "get_body_battery_events",
    "ALL_DAY_STRESS": "get_all_day_stress",
    "TRAINING_READINESS": "get_training_readiness",
    "TRAINING_STATUS": "get_training_status",
    "FLOORS": "get_floors",
    "RESPIRATION": "get_respiration_data",
    "SPO2": "get_spo2_data",
    "INTENSITY_MINUTES": "get_intensity_minutes_data",
    "MAX_METRICS": "get_max_metrics",
    "HYDRATION": "get_hydration_data",
}
# Landed by key discovery, not by date window.
KEYED_METHODS = {
    "ACTIVITIES": "get_activities",
    "ACTIVITY_DETAILS": "get_activity_details",
}
# A range collector is fetched by window, a daily one by single day.
COLLECTORS = [
    Row(collector_name=name, source_method=method, kind=kind)
    for kind, methods in (("range", RANGE_METHODS), ("daily", DAILY_METHODS))
    for name, method in methods.items()
]
REGISTRY_TYPE = "array<struct<collector_name:string,source_method:string,kind:string>>"
LANDED_TABLES = [*RANGE_METHODS, *DAILY_METHODS, *KEYED_METHODS]


def select_collectors(only: str | Iterable[str] | None = None) -> list[Row]:
    """All collectors, or those named by a list or a text such as ``"stats, sleep"``."""
    if not only:
        return COLLECTORS
    wanted = only.split(",") if isinstance(only, str) else only
    names = {name.strip().upper() for name in wanted}
    return [c for c in COLLECTORS if c.collector_name in names]


def selected_tables(only: str | Iterable[str] | None = None) -> set[str]:
    """All landed tables, or those named, activities and their details among them."""
    if not only:
        return set(LANDED_TABLES)
    wanted = only.split(",") if isinstance(only, str) else only
    return {name.strip().upper() for name in wanted} & set(LANDED_TABLES)


def with_collectors(subjects: DataFrame, only: str | Iterable[str] | None = None) -> DataFrame:
    """One row per subject and selected collector, without a join.

    The registry is a constant of at most 20 entries, so it rides along as an
    array literal and is expanded in place.
    """
    entries = [F.struct(*[F.lit(v).alias(k) for k, v in c.asDict().items()]) for c in select_collectors(only)]
    return subjects.select("*", F.inline(F.array(*entries).cast(REGISTRY_TYPE)))
