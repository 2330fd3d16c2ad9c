"""Intervals of days: coverage as islands, and what is left to ask for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def coverage_islands(facts: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """``by, start_date, end_date, num_days`` of every run of days with a fact, and the gap behind it.

    ``gap_days`` counts the days up to the group's next run; it is null behind the last one. Facts
    shrink to distinct group-days before the shuffle, so a window holds a group's days, of which
    there are as many as the calendar has, however many facts the group has. Null days are left out.
    """
    by = list(by)
    days = facts.select(*by, F.col(day).cast("date").alias("_day")).filter("_day is not null").distinct()
    order = Window.partitionBy(*by).orderBy("_day")
    # The days of one run share the day that lies their number before them.
    numbered = days.withColumn("_run", F.date_sub("_day", F.row_number().over(order)))
    runs = numbered.groupBy(*by, "_run").agg(F.min("_day").alias("start_date"), F.max("_day").alias("end_date"), F.count(F.lit(1)).alias("num_days"))
    following = F.lead("start_date").over(Window.partitionBy(*by).orderBy("start_date"))
    return runs.select(*by, "start_date", "end_date", "num_days", (F.datediff(following, "end_date") - 1).alias("gap_days"))


def _steps(intervals: DataFrame, by: list[str], name: str) -> DataFrame:
    """Where intervals begin (+1) and the day after they end (-1), summed up a group and day; empty ones are left out."""
    real = intervals.filter("start_date <= end_date")
    step = F.explode(F.array(F.struct(F.col("start_date").alias("at"), F.lit(1).alias("n")), F.struct(F.date_add("end_date", 1).alias("at"), F.lit(-1).alias("n"))))
    return real.select(*by, step.alias("_s")).groupBy(*by, F.col("_s.at").alias("at")).agg(F.sum("_s.n").alias(name))


def _covered(changes: DataFrame, by: list[str], holds) -> DataFrame:
    """``by, start_date, end_date`` of the longest intervals on which ``holds`` is true of the running sums.

    ``changes`` has a row a group and day at which a sum changes: at most as many as the calendar has days.
    """
    w = Window.partitionBy(*by).orderBy("at")
    sums = [c for c in changes.columns if c not in (*by, "at")]
    running = changes.select(*by, "at", *[F.sum(c).over(w).alias(c) for c in sums]).withColumn("_in", holds)
    # A row begins an interval if it is in and the row before is not; the next row that is out ends it.
    before = F.coalesce(F.lag("_in").over(w), F.lit(False))
    edges = running.withColumn("_before", before).filter("_in <> _before")
    until = F.date_sub(F.lead("at").over(w), 1)
    return edges.withColumn("end_date", until).filter("_in").select(*by, F.col("at").alias("start_date"), "end_date")


def merged_intervals(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overlapping and adjacent ``[start_date, end_date]`` of a group as one, both ends included."""
    by = list(by)
    return _covered(_steps(intervals, by, "n"), by, F.col("n") > 0)


def open_intervals(requested: DataFrame, answered: DataFrame, by: Sequence[str]) -> DataFrame:
    """The days of ``requested`` intervals that no ``answered`` one holds, as the longest intervals.

    Both have ``start_date`` and ``end_date``, both ends included, and may overlap; a null end, or one before the start, is no interval.
    """
    by = list(by)
    asked, had = _steps(requested, by, "asked"), _steps(answered, by, "had")
    both = asked.withColumn("had", F.lit(0).cast("long")).unionByName(had.withColumn("asked", F.lit(0).cast("long")))
    changes = both.groupBy(*by, "at").agg(F.sum("asked").alias("asked"), F.sum("had").alias("had"))
    return _covered(changes, by, (F.col("asked") > 0) & (F.col("had") <= 0))
