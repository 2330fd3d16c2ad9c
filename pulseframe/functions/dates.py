"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 6, 7  # ISO day numbers


def day_parts(d: Column) -> dict[str, Column]:
    """The 25 descriptive columns of a calendar day, in mart order.

    Weeks start on Sunday while the week number is the ISO one;
    "year over year" is 52 whole weeks back, so weekdays line up.
    """
    week_start = F.date_sub(d, F.dayofweek(d) - 1)
    quarter_start = F.trunc(d, "quarter")
    return {
        "date_day": d,
        "prior_date_day": F.date_sub(d, 1),
        "next_date_day": F.date_add(d, 1),
        "prior_year_date_day": F.add_months(d, -12),
        "prior_year_over_year_date_day": F.date_sub(d, 52 * 7),
        "day_of_week": F.dayofweek(d),
        "day_of_week_iso": F.weekday(d) + 1,
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_name_short": F.date_format(d, "EEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_start_date": week_start,
        "week_end_date": F.date_add(week_start, 6),
        "week_of_year": F.weekofyear(d),
        "month_of_year": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": F.last_day(d),
        "quarter_of_year": F.quarter(d),
        "quarter_start_date": quarter_start,
        "quarter_end_date": F.last_day(F.add_months(quarter_start, 2)),
        "year_number": F.year(d),
        "year_start_date": F.trunc(d, "year"),
        "year_end_date": F.make_date(F.year(d), F.lit(12), F.lit(31)),
    }


def year_ago_parts(d: Column) -> dict[str, Column]:
    """The 11 columns that complete :func:`day_parts` to the whole date dimension.

    Assumed from the public package's documentation: weeks of a year ago are those of the day 52
    weeks back, months those of the same calendar day one year back.
    """
    weeks_back, year_back = F.date_sub(d, 52 * 7), F.add_months(d, -12)
    week_start = F.date_sub(weeks_back, F.dayofweek(weeks_back) - 1)
    return {
        "prior_year_week_start_date": week_start,
        "prior_year_week_end_date": F.date_add(week_start, 6),
        "iso_week_start_date": F.trunc(d, "week"),
        "iso_week_end_date": F.date_add(F.trunc(d, "week"), 6),
        "prior_year_iso_week_start_date": F.trunc(weeks_back, "week"),
        "prior_year_iso_week_end_date": F.date_add(F.trunc(weeks_back, "week"), 6),
        "iso_week_of_year": F.weekofyear(d),
        "prior_year_week_of_year": F.weekofyear(weeks_back),
        "prior_year_iso_week_of_year": F.weekofyear(weeks_back),
        "prior_year_month_start_date": F.trunc(year_back, "month"),
        "prior_year_month_end_date": F.last_day(year_back),
    }


def day_flags(today: Column) -> dict[str, Column]:
    """Reporting flags over the columns of :func:`day_parts`."""
    return {
        "is_weekend": F.col("day_of_week_iso").isin(SATURDAY, SUNDAY),
        "is_current_date": F.col("date_day") == today,
        "is_first_day_of_month": F.col("day_of_month") == 1,
        "is_last_day_of_month": F.col("date_day") == F.col("month_end_date"),
    }


def today_in(zone: str, now: Column | None = None) -> Column:
    """Today's date in ``zone`` (the session's own zone plays no part), or the date of the instant ``now``."""
    wall_clock = (F.current_timestamp() if now is None else now).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(zone), wall_clock).cast("date")


def day_sequence(start: Column, end: Column, step_days: int = 1) -> Column:
    """Days from ``start`` to ``end`` inclusive; NULL, hence no rows, when start > end."""
    step = F.expr(f"interval {step_days} day")
    return F.when(start <= end, F.sequence(start, end, step))
