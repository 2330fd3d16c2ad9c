"""Day spine, date dimension, and calendar coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import dates

DEFAULT_TIME_ZONE = "America/Los_Angeles"  # fixed value: zone that decides "today"
DEFAULT_START = "2020-01-01"  # fixed value: first day of the calendar
HORIZON_DAYS = 365  # fixed value: the calendar runs this far past today


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date", end_inclusive: bool = False) -> DataFrame:
    """One row per day between the columns of a one-row ``bounds`` frame; the end is exclusive by default."""
    last = F.col(end) if end_inclusive else F.date_sub(end, 1)
    return bounds.select(F.explode(dates.day_sequence(F.col(start), last)).alias("date_day"))


def describe_days(spine: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All 25 descriptive columns of every ``date_day``, after the columns in ``keep``."""
    return spine.select(*keep, *[c.alias(n) for n, c in dates.day_parts(F.col("date_day")).items()])


def describe_all(spine: DataFrame) -> DataFrame:
    """The whole date dimension: the columns the mart shows, and ISO weeks, and weeks and months a year ago."""
    more = dates.year_ago_parts(F.col("date_day"))
    return describe_days(spine).select("*", *[c.alias(n) for n, c in more.items()])


def dim_dates(spine: DataFrame, today: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Date dimension: descriptive columns plus reporting flags as of ``today``."""
    described = describe_days(spine, keep)
    return described.select("*", *[c.alias(n) for n, c in dates.day_flags(today).items()])


def default_bounds(spark, today: str | None = None, zone: str = DEFAULT_TIME_ZONE) -> DataFrame:
    """The default calendar: fixed first day, one year past today."""
    day = F.lit(today).cast("date") if today else dates.today_in(zone)
    return spark.range(1).select(
        F.lit(DEFAULT_START).cast("date").alias("start_date"),
        F.date_add(day, HORIZON_DAYS).alias("end_date"),
    )


def gap_days(facts: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Days without a fact between each group's first and last one.

    Facts shrink to distinct group-days first; every later step keeps the
    group's partitioning or joins on the full (group, day) key.
    """
    present = facts.select(*by, F.col(day).alias("date_day")).distinct()
    span = present.groupBy(*by).agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))
    expected = span.select(*by, F.explode(dates.day_sequence(F.col("lo"), F.col("hi"))).alias("date_day"))
    return expected.join(present, [*by, "date_day"], "left_anti")
