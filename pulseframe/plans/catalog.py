"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``.

Results carry no VARIANT and no zone-dependent instant: instants are shown as
UTC wall clock, local readings as the wall clock they were written in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions import keys, paths
from pulseframe.functions.dates import day_sequence, today_in
from pulseframe.operators import calendar, discovery, drift, intervals, normalize, quality, samples, watermarks
from pulseframe.operators.upsert import LandedTable, existing_keys, latest_by_key, upsert
from pulseframe.plans import project, staging
from pulseframe.plans.models import import_models
from pulseframe.plans.refresh import StoredModel
from pulseframe.plans.runs import details_to_fetch, full_run as run_all, land_details, land_new_activities, land_run
from pulseframe.session import shared_dir, shuffle_partitions
from pulseframe.sources import payloads
from pulseframe.sources.envelope import parse_rows, stage_rows, to_envelope
from pulseframe.sources.registry import with_collectors
from pulseframe.streaming.landing import land_stream, payload_stream, without_replays

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TODAY = "2024-02-01"
SUBJECT_KEYS = ("subject_id", "natural_key")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _utc(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: paths.instant_to_utc_ntz(F.col(c)) for c in cols})


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# Landing


def _event_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.table(spark, sf, "events").repartition(shuffle_partitions(spark)).select(
        "event_id",
        "event_type",
        "ts",
        F.col("user_id").alias("subject_id"),
        F.struct("value", F.get_json_object("props", "$.k").cast("int").alias("k")).alias("payload"),
    )


def _show_event(rows: DataFrame) -> DataFrame:
    raw = F.col("raw_data")
    return rows.select(
        *[c for c in ("subject_id",) if c in rows.columns],
        "natural_key",
        paths.as_float(raw, "$.value").alias("value"),
        paths.as_int(raw, "$.k").alias("k"),
        "extracted_at",
        "source_method",
    )


@query
def land_envelope(spark, sf):
    staged = stage_rows(
        _event_payloads(spark, sf).drop("subject_id"),
        key=F.col("event_id"),
        payload=F.col("payload"),
        source_method="get_events",
        extracted_at="2024-02-01T02:00:00-08:00",
    )
    return _show_event(parse_rows(staged))


@query
def quarantine_split(spark, sf):
    """Error events arrive with broken JSON."""
    text = F.to_json("payload")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), text)).otherwise(text)
    staged = stage_rows(
        _event_payloads(spark, sf),
        key=F.col("event_id"),
        payload=broken,
        source_method="get_events",
        extracted_at=payloads.EXTRACTED_AT,
        payload_is_json=True,
    )
    parsed = parse_rows(staged, strict=False)
    return parsed.select(
        "natural_key",
        F.col("rejected_text").isNotNull().alias("is_quarantined"),
        paths.as_int(F.col("raw_data"), "$.k").alias("k"),
        "rejected_text",
    )


@query
def normalize_range_payload(spark, sf):
    rows = normalize.normalize_range(payloads.range_payloads(spark, sf))
    return rows.select(
        "subject_id",
        "natural_key",
        paths.as_int(F.col("raw_data"), "$.totalSteps").alias("total_steps"),
        "source_method",
    )


@query
def derive_row_key(spark, sf):
    found = normalize.explode_range_items(payloads.range_payloads(spark, sf))
    dated = normalize.row_key(F.col("item"), F.lit(None).cast("string"))
    return found.select(
        "subject_id", "chunk_start", F.col("position").cast("int"), dated.alias("date_key")
    )


@query
def normalize_daily_payload(spark, sf):
    rows = normalize.normalize_daily(payloads.sync_payloads(spark, sf, "BODY_BATTERY_EVENTS"))
    return rows.select(
        "subject_id",
        "natural_key",
        paths.array_size(F.col("raw_data")).alias("num_items"),
        paths.as_string(F.col("raw_data"), "$[0].eventType").alias("first_event_type"),
        "source_method",
    )


@query
def landed_tables(spark, sf):
    """All 20 collectors landed and upserted in one job, keyed by collector."""
    # Each summary row becomes 20 payloads: keep all cores on it.
    days = payloads.user_days(spark, sf).repartition(shuffle_partitions(spark))
    fetched = with_collectors(days).select(
        "subject_id",
        "collector_name",
        "kind",
        "source_method",
        F.col("day").alias("requested"),
        F.col("day").alias("chunk_start"),
        F.to_json(F.struct(F.col("day").alias("calendarDate"), "sum_k")).alias("payload"),
    )
    is_range = F.col("kind") == "range"
    rows = normalize.normalize_range(fetched.filter(is_range)).unionByName(
        normalize.normalize_daily(fetched.filter(~is_range))
    )
    landed = to_envelope(rows, extracted_at=payloads.EXTRACTED_AT)
    current = latest_by_key(landed, ("collector_name", *SUBJECT_KEYS))
    day = F.col("natural_key").cast("date")
    return current.groupBy("collector_name").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.sum(paths.as_int(F.col("raw_data"), "$.sum_k")).cast("bigint").alias("total_k"),
    )


# Incremental load


def _event_batch(rows: DataFrame, extracted_at: str, batch_seq: int) -> DataFrame:
    staged = stage_rows(
        rows,
        key=F.col("event_type"),
        payload=F.col("payload"),
        source_method="get_events",
        extracted_at=extracted_at,
        batch_seq=batch_seq,
        row_seq=F.col("event_id"),
    )
    return parse_rows(staged)


def _two_batches(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = _event_payloads(spark, sf)
    split = F.expr("ts < timestamp_ntz'2024-01-16 00:00:00'")
    return (
        _event_batch(rows.filter(split), "2024-01-16T02:00:00Z", 1),
        _event_batch(rows.filter(~split), "2024-02-01T02:00:00Z", 2),
    )


@query
def upsert_latest(spark, sf):
    base, update = _two_batches(spark, sf)
    return _show_event(latest_by_key(base.unionByName(update), SUBJECT_KEYS))


@query
def upsert_merge(spark, sf):
    """The same outcome, landing the second batch on the table the first one left."""
    base, update = _two_batches(spark, sf)
    return _show_event(upsert(latest_by_key(base, SUBJECT_KEYS), update, SUBJECT_KEYS))


@query
def snapshot_upsert(spark, sf):
    """The same once more from storage: a snapshot of the first batch, whose rows are retired, and the second."""
    base, update = _two_batches(spark, sf)
    table = LandedTable(spark, f"{shared_dir(spark, 'snapshot-upsert')}/events", SUBJECT_KEYS)
    table.append(base, 1)
    table.compact(1)
    table.retire(1)
    table.append(update, 2)
    return _show_event(table.current())


@query
def existing_keys_orders(spark, sf):
    lines = payloads.table(spark, sf, "lineitem")
    return existing_keys(lines.select(F.col("l_orderkey").cast("string").alias("natural_key")))


def _missing_details(spark, sf) -> DataFrame:
    orders = payloads.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("natural_key"))
    detailed = (
        payloads.table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").cast("string").alias("natural_key"))
    )
    return discovery.missing_keys(orders, detailed)


@query
def missing_details_anti(spark, sf):
    return _missing_details(spark, sf).orderBy("natural_key")


@query
def fetch_batches(spark, sf):
    return discovery.fetch_batches(_missing_details(spark, sf), shared_dir(spark, "fetch-batches"))


def _feed(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Events newest first; errors before 28 January are known already."""
    e = payloads.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    known = e.filter("event_type = 'error' and ts < timestamp_ntz'2024-01-28 00:00:00'")
    return (
        e.select(F.col("event_id").cast("string").alias("activity_id"), "user_id", F.col("event_id").alias("recency")),
        known.select(F.col("event_id").cast("string").alias("activity_id"), "user_id"),
    )


@query
def new_until_known(spark, sf):
    feed, known = _feed(spark, sf)
    return discovery.new_until_known(feed, known, "activity_id", "recency")


@query
def new_until_known_by_subject(spark, sf):
    feed, known = _feed(spark, sf)
    return discovery.new_until_known_by(feed, known, "activity_id", "recency", "user_id")


def _paged_feed(spark, sf, size: int) -> DataFrame:
    """Each user's events newest first, on pages of ``size``; the service withholds some entries and one page in nine."""
    feed, _ = _feed(spark, sf)
    order = feed.withColumn("_age", -F.col("recency")).orderBy("user_id", "_age")
    placed = discovery.number_in_order(order, shared_dir(spark, "paged-feed"))
    first = placed.groupBy("user_id").agg(F.min("row_index").alias("_first"))
    page = F.floor((F.col("row_index") - F.col("_first")) / size)
    paged = placed.join(first, "user_id").withColumn("page", page)
    held_back = (F.col("recency") % 97 == 0) | ((F.col("user_id") + F.col("page")) % 9 == 8)
    return paged.filter(~held_back).select("activity_id", "user_id", "recency", "page")


@query
def new_until_short_page(spark, sf):
    """Each user's newest activities, read page by page up to the first known one or the first page that is not full."""
    _, known = _feed(spark, sf)
    old = known.filter("cast(activity_id as bigint) % 4 = 0")
    return discovery.new_until_stop(_paged_feed(spark, sf, 10), old, "activity_id", "recency", "page", "user_id", size=10)


# Which collector each event type stands for; purchases have never run.
_STATE_COLLECTORS = {"click": "STEPS", "view": "SLEEP", "signup": "HRV", "error": "BODY_BATTERY"}


def _subjects_and_state(spark, sf) -> tuple[DataFrame, DataFrame]:
    e = payloads.events(spark, sf)
    name = F.create_map(*[F.lit(x) for kv in _STATE_COLLECTORS.items() for x in kv])
    state = (
        e.filter(F.col("event_type").isin(*_STATE_COLLECTORS))
        .groupBy(F.col("user_id").alias("subject_id"), name[F.col("event_type")].alias("collector_name"))
        .agg(F.max("day").alias("last_extracted_date"), paths.ms_to_ntz(F.max("ms")).alias("updated_at"))
    )
    return e.select(F.col("user_id").alias("subject_id")).distinct(), state


@query
def watermark_start(spark, sf):
    subjects, state = _subjects_and_state(spark, sf)
    planned = watermarks.fetch_windows(subjects, state, TODAY)
    backfill = watermarks.fetch_windows(subjects, state, TODAY, since="2023-08-09", only=" steps,sleep ")
    label = lambda df, v: df.select(F.lit(v).alias("run"), "*")
    return label(planned, "incremental").unionByName(label(backfill, "backfill"))


@query
def daily_fetch_plan(spark, sf):
    subjects, state = _subjects_and_state(spark, sf)
    return watermarks.daily_requests(watermarks.fetch_windows(subjects, state, TODAY))


@query
def range_fetch_plan(spark, sf):
    subjects, state = _subjects_and_state(spark, sf)
    windows = watermarks.fetch_windows(subjects, state, TODAY, since="2023-08-09")
    return watermarks.range_requests(windows)


@query
def chunk_date_ranges(spark, sf):
    spans = (
        payloads.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("start_date"), F.to_date(F.max("o_orderdate")).alias("end_date"))
    )
    return watermarks.chunk_ranges(spans)


@query
def watermark_advance(spark, sf):
    """A run of every subject's steps and stats collectors on the fixed day."""
    subjects, state = _subjects_and_state(spark, sf)
    ran = with_collectors(subjects, "steps,stats")
    return watermarks.advance(state, ran, TODAY, F.expr("timestamp_ntz'2024-02-01 10:00:00'"))


@query
def late_refetch_upsert(spark, sf):
    """Errors sync late: the run of 16 January misses them, the next run re-opens three days."""
    e = payloads.events(spark, sf).withColumnRenamed("user_id", "subject_id")
    last_run, run = F.lit("2024-01-16").cast("date"), F.lit(TODAY).cast("date")
    reopened = F.date_sub(last_run, watermarks.REFETCH_BUFFER_DAYS)

    def daily(rows: DataFrame, extracted_at: str, batch_seq: int) -> DataFrame:
        days = rows.groupBy("subject_id", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"))
        fetched = days.select(
            "subject_id",
            F.col("day").alias("requested"),
            F.to_json(F.struct("n", "sum_k")).alias("payload"),
            F.lit("get_stats").alias("source_method"),
        )
        return to_envelope(normalize.normalize_daily(fetched), extracted_at=extracted_at, batch_seq=batch_seq)

    first = daily(e.filter((F.col("event_type") != "error") & (F.col("day") <= last_run)), "2024-01-16T10:00:00Z", 1)
    second = daily(e.filter(F.col("day").between(reopened, run)), "2024-02-01T10:00:00Z", 2)
    raw = F.col("raw_data")
    return upsert(first, second, SUBJECT_KEYS).select(
        *SUBJECT_KEYS,
        paths.as_int(raw, "$.n").alias("n"),
        paths.as_int(raw, "$.sum_k").alias("sum_k"),
        "extracted_at",
    )


@query
def collector_runs(spark, sf):
    """Two stored runs from request to landed row: the second re-opens three days and finds late errors."""
    root = shared_dir(spark, "collector-runs")
    table = LandedTable(spark, f"{root}/landed", ("collector_name", *SUBJECT_KEYS), ("collector_name",))
    state = watermarks.StateLog(spark, f"{root}/state", "subject_id bigint")
    e = payloads.events(spark, sf).withColumnRenamed("user_id", "subject_id")
    subjects = e.select("subject_id").distinct()

    def run(rows: DataFrame, run_date: str, run_seq: int) -> None:
        windows = watermarks.fetch_windows(
            subjects, state.current(before=run_seq), run_date, only="sleep,hrv,steps"
        )
        days = rows.groupBy("subject_id", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"))
        daily = watermarks.daily_requests(windows).join(
            days.withColumnRenamed("day", "requested"), ["subject_id", "requested"]
        )
        # Joined day by day: a chunk has 27 of them, and a subject one row for each.
        chunks = watermarks.range_requests(windows)
        ranged = (
            chunks.withColumn("day", F.explode(day_sequence(F.col("chunk_start"), F.col("chunk_end"))))
            .join(days, ["subject_id", "day"])
            .groupBy(*[c for c in chunks.columns if c != "chunk_end"])
            .agg(F.collect_list(F.struct(F.col("day").alias("calendarDate"), "n", "sum_k")).alias("found"))
        )
        land_run(
            table,
            state,
            windows,
            ranged.withColumn("payload", F.to_json("found")).drop("found"),
            daily.withColumn("payload", F.to_json(F.struct("n", "sum_k"))),
            run_date,
            f"{run_date}T10:00:00Z",
            run_seq,
        )

    run(e.filter((F.col("event_type") != "error") & (F.col("day") <= F.lit("2024-01-16").cast("date"))), "2024-01-16", 1)
    run(e, TODAY, 2)
    raw = F.col("raw_data")
    return table.current().select(
        "collector_name",
        *SUBJECT_KEYS,
        paths.as_int(raw, "$.n").alias("n"),
        paths.as_int(raw, "$.sum_k").alias("sum_k"),
        "extracted_at",
        "source_method",
    )


@query
def activity_runs(spark, sf):
    """Two activity runs and one of details; what is still missing, in write batches.

    The first run sees errors before 28 January. Signups answer with empty
    details and clicks with broken ones.
    """
    root = shared_dir(spark, "activity-runs")
    table = LandedTable(spark, f"{root}/landed", ("collector_name", "natural_key"), ("collector_name",))
    payload = F.to_json(F.struct("event_type", "value"))
    feed = payloads.table(spark, sf, "events").repartition(shuffle_partitions(spark)).select(
        F.col("event_id").cast("string").alias("natural_key"),
        F.col("event_id").alias("recency"),
        "event_type",
        "ts",
        payload.alias("payload"),
    )
    first = feed.filter("event_type = 'error' and ts < timestamp_ntz'2024-01-28 00:00:00'")
    land_new_activities(table, first, "recency", "2024-01-28T02:00:00Z", 1)
    land_new_activities(table, feed, "recency", "2024-02-01T02:00:00Z", 2)
    answer = (
        F.when(F.col("event_type") == "signup", F.lit("{}"))
        .when(F.col("event_type") == "click", F.lit("{broken"))
        .otherwise(F.col("payload"))
    )
    fetched = details_to_fetch(table, before=3).join(feed, "natural_key").withColumn("payload", answer)
    land_details(table, fetched, "2024-02-01T03:00:00Z", 3)
    return discovery.fetch_batches(details_to_fetch(table), f"{root}/batches")


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by key over the whole shuffle width: a payload's bytes say little of its work, and adaptive execution merges by bytes."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), *keys)


def _subjects_of_events(spark, sf) -> DataFrame:
    return payloads.table(spark, sf, "events").select(F.col("user_id").alias("subject_id")).distinct()


def _events_of_subjects(spark, sf) -> DataFrame:
    return _spread(payloads.table(spark, sf, "events"), "event_id").select(
        F.col("user_id").alias("subject_id"),
        F.col("event_id").cast("string").alias("natural_key"),
        F.col("event_id").alias("recency"),
        "event_type",
        "ts",
        F.to_json(F.struct("event_type", "value")).alias("payload"),
    )


def _subject_table(spark, root: str) -> LandedTable:
    return LandedTable(spark, f"{root}/landed", ("collector_name", *SUBJECT_KEYS), ("collector_name",))


@query
def activity_runs_by_subject(spark, sf):
    """As ``activity_runs``, for many subjects: each has its own cut and its own ids."""
    root = shared_dir(spark, "activity-runs-by-subject")
    table, feed = _subject_table(spark, root), _events_of_subjects(spark, sf)
    first = feed.filter("event_type = 'error' and ts < timestamp_ntz'2024-01-28 00:00:00'")
    land_new_activities(table, first, "recency", "2024-01-28T02:00:00Z", 1)
    land_new_activities(table, feed, "recency", "2024-02-01T02:00:00Z", 2)
    answer = (
        F.when(F.col("event_type") == "signup", F.lit("{}"))
        .when(F.col("event_type") == "click", F.lit("{broken"))
        .otherwise(F.col("payload"))
    )
    fetched = details_to_fetch(table, before=3).join(feed, list(SUBJECT_KEYS)).withColumn("payload", answer)
    land_details(table, fetched, "2024-02-01T03:00:00Z", 3)
    return details_to_fetch(table)


def _landed_counts(table: LandedTable) -> DataFrame:
    return table.current().groupBy("collector_name").agg(
        F.count(F.lit(1)).alias("num_rows"), F.countDistinct("subject_id").alias("num_subjects")
    )


def _days_of_subjects(spark, sf) -> DataFrame:
    e = payloads.events(spark, sf).withColumnRenamed("user_id", "subject_id")
    days = e.groupBy("subject_id", F.col("day").alias("requested")).agg(F.sum("k").alias("sum_k"))
    return days.withColumn("payload", F.to_json(F.struct("sum_k")))


def _answers(spark, sf, feed: DataFrame, since: str, broken: Column | None = None) -> dict:
    """What requests of a whole run are answered with: every event day, ranges in chunks from ``since``.

    A chunk's payload makes up to 27 rows for each collector that asks for it, so answers are spread by their
    number. Days are unique and far fewer than the requests, which are looked up in them unsorted.
    """
    days = _days_of_subjects(spark, sf)
    chunks = payloads.range_payloads(spark, sf, since).drop("source_method")
    payload = F.col("payload") if broken is None else broken
    return {
        "activities": lambda: feed,
        "details": lambda missing: missing.join(feed, list(SUBJECT_KEYS)).withColumn("payload", payload),
        "range": lambda requests: _spread(requests, "subject_id", "chunk_start").join(chunks, ["subject_id", "chunk_start"]),
        "daily": lambda requests: _spread(requests, "subject_id", "requested").join(days.hint("shuffle_hash"), ["subject_id", "requested"]),
    }


def _event_days(spark, sf) -> tuple[str, str]:
    """First and last day with an event."""
    first, last = payloads.events(spark, sf).agg(F.min("day"), F.max("day")).first()
    return first.isoformat(), last.isoformat()


@query
def mixed_writers(spark, sf):
    """Collectors, activities and details landed under one run number, some collectors apart, and all of it once more around a snapshot."""
    root = shared_dir(spark, "mixed-writers")
    table, feed = _subject_table(spark, root), _events_of_subjects(spark, sf)
    state = watermarks.StateLog(spark, f"{root}/state", "subject_id bigint")
    since, today = _event_days(spark, sf)
    answers, at = _answers(spark, sf, feed, since), f"{today}T10:00:00Z"
    subjects = _subjects_of_events(spark, sf)

    def collect(only: str) -> None:
        windows = watermarks.fetch_windows(subjects, state.current(before=1), today, since, only)
        ranged, daily = answers["range"](watermarks.range_requests(windows)), answers["daily"](watermarks.daily_requests(windows))
        land_run(table, state, windows, ranged, daily, today, at, 1)

    collect("sleep,steps")
    land_new_activities(table, feed, "recency", at, 1)
    table.compact(1)
    table.retire(1)
    collect("hrv,floors,weigh_ins")
    land_details(table, feed, at, 1)
    collect("sleep,steps")  # the snapshot has this batch already
    return _landed_counts(table)


@query
def full_run(spark, sf):
    """A whole run of all tables over all days of the events, and one for the details that came empty."""
    root = shared_dir(spark, "full-run")
    table, feed = _subject_table(spark, root), _events_of_subjects(spark, sf)
    state = watermarks.StateLog(spark, f"{root}/state", "subject_id bigint")
    since, today = _event_days(spark, sf)
    late = F.when(F.col("event_type") == "signup", F.lit("{}")).otherwise(F.col("payload"))
    subjects = _subjects_of_events(spark, sf)
    run_all(table, state, subjects, _answers(spark, sf, feed, since, late), today, f"{today}T10:00:00Z", 1, since=since)
    run_all(table, state, subjects, _answers(spark, sf, feed, since), today, f"{today}T11:00:00Z", 2, only="activity_details")
    return _landed_counts(table)


@query
def staged_counts(spark, sf):
    """Rows staged by table, as the writing jobs counted them: a whole run, its repetition for some tables, and an empty answer."""
    root = shared_dir(spark, "staged-counts")
    table, feed = _subject_table(spark, root), _events_of_subjects(spark, sf)
    state = watermarks.StateLog(spark, f"{root}/state", "subject_id bigint")
    since, today = _event_days(spark, sf)
    broken = F.when(F.col("event_type") == "click", F.lit("{broken")).otherwise(F.col("payload"))
    answers = _answers(spark, sf, feed, since, broken)
    subjects, at = _subjects_of_events(spark, sf), f"{today}T10:00:00Z"
    none = {"range": lambda r: answers["range"](r).filter("false"), "daily": lambda r: answers["daily"](r).filter("subject_id < 0")}
    runs = [
        run_all(table, state, subjects, answers, today, at, 1, since=since),
        run_all(table, state, subjects, answers, today, at, 2, only="activities,sleep,steps", since=since),
        run_all(table, state, subjects, none, today, at, 3, only="hrv,steps", since=since),
    ]
    counted = [(n, name, staged) for n, run in enumerate(runs, 1) for name, staged in run.items()]
    return spark.createDataFrame(counted, "run int, collector_name string, rows_staged long").coalesce(1)


@query
def retired_snapshot(spark, sf):
    """Batches land before, after and behind snapshots whose rows are retired, and one lands again: none is lost."""
    rows = _event_payloads(spark, sf)
    table = LandedTable(spark, f"{shared_dir(spark, 'retired-snapshot')}/events", SUBJECT_KEYS)

    def part(condition: str, batch_seq: int, writer: str = "main") -> None:
        table.append(_event_batch(rows.filter(condition), "2024-02-01T02:00:00Z", batch_seq), batch_seq, writer)

    part("event_id % 4 = 0", 1)
    table.compact(1)
    table.retire(1)
    part("event_id % 4 = 1", 5)
    table.compact(5)
    part("event_id % 4 = 2", 2)  # behind the snapshot by its number
    part("event_id % 4 < 2", 5)  # again, with more
    part("event_id % 4 = 3", 3, "other")
    table.compact(6)
    table.retire(6)
    part("event_id % 4 = 2 and event_id % 3 = 0", 2)
    raw = F.col("raw_data")
    # At one extraction time the batch decides, then the row.
    return table.current().select(*SUBJECT_KEYS, paths.as_float(raw, "$.value").alias("value"), "batch_seq", "row_seq")


@query
def bucket_upsert(spark, sf):
    """Versions of a table in buckets by subject: each later batch has a few subjects, and rewrites their buckets alone."""
    rows = _event_payloads(spark, sf)
    root = shared_dir(spark, "bucket-upsert")
    table = LandedTable(spark, f"{root}/events", SUBJECT_KEYS, bucket_by="pmod(subject_id, 16)")
    early = "ts < timestamp_ntz'2024-01-16 00:00:00'"
    table.append(_event_batch(rows.filter(early), "2024-01-16T02:00:00Z", 1), 1)
    table.compact(1)
    late = rows.filter(f"not ({early})")
    for batch_seq, some in ((2, "pmod(subject_id, 16) < 3"), (3, "pmod(subject_id, 16) between 3 and 9"), (4, "pmod(subject_id, 16) > 9")):
        table.append(_event_batch(late.filter(some), "2024-02-01T02:00:00Z", batch_seq), batch_seq)
        if batch_seq < 4:
            table.compact(batch_seq)
    return _show_event(table.current())


@query
def change_feed(spark, sf):
    """Keys that two versions of a table inserted and replaced, and those landed since."""
    rows = _event_payloads(spark, sf)
    table = LandedTable(spark, f"{shared_dir(spark, 'change-feed')}/events", SUBJECT_KEYS)
    days = ["2024-01-08", "2024-01-16", "2024-01-24", "2100-01-01"]
    for n, (start, end) in enumerate(zip(["1900-01-01", *days], days), 1):
        within = rows.filter(f"ts >= timestamp_ntz'{start} 00:00:00' and ts < timestamp_ntz'{end} 00:00:00'")
        table.append(_event_batch(within, f"{days[min(n, 3) - 1]}T02:00:00Z", n), n)
        if n < 4:
            table.compact(n)
    table.retire(2)
    label = lambda df, v: df.select(F.lit(v).alias("span"), *SUBJECT_KEYS, "change", F.col("row_seq").alias("event_id"))
    return label(table.changes(1, 3), "between").unionByName(label(table.changes(3), "since"))


@query
def pending_details(spark, sf):
    """As ``activity_runs_by_subject``, with what lacks details kept up to date from the changes of each version."""
    root = shared_dir(spark, "pending-details")
    table, feed = _subject_table(spark, root), _events_of_subjects(spark, sf)
    first = feed.filter("event_type = 'error' and ts < timestamp_ntz'2024-01-28 00:00:00'")
    # Details of some activities come before the feed does.
    land_details(table, feed.filter("event_type = 'purchase' and recency % 2 = 0"), "2024-01-27T02:00:00Z", 1)
    land_new_activities(table, first, "recency", "2024-01-28T02:00:00Z", 1)
    table.compact(1)
    land_new_activities(table, feed, "recency", "2024-02-01T02:00:00Z", 2)
    table.compact(2)
    answer = (
        F.when(F.col("event_type") == "signup", F.lit("{}"))
        .when(F.col("event_type") == "click", F.lit("{broken"))
        .otherwise(F.col("payload"))
    )
    land_details(table, feed.withColumn("payload", answer), "2024-02-01T03:00:00Z", 3)
    table.compact(3)
    pending = spark.createDataFrame([], "subject_id bigint, natural_key string, has_wanted boolean, has_answer boolean")
    for after, upto in ((None, 1), (1, 2), (2, 3)):
        pending = discovery.update_pending(pending, table.changes(after, upto), SUBJECT_KEYS, "ACTIVITIES", "ACTIVITY_DETAILS")
        path = f"{root}/pending/version={upto}"
        pending.write.parquet(path)
        pending = spark.read.parquet(path)
    return pending.filter("has_wanted").select(*SUBJECT_KEYS)


@query
def cardio_refreshed(spark, sf):
    """The stored cardio model after activities were added and replaced, refreshed for these alone."""
    root = shared_dir(spark, "cardio-refreshed")
    table = LandedTable(spark, f"{root}/details")
    texts = payloads.activity_detail_payloads(spark, sf)
    block = F.col("natural_key").cast("bigint")
    stale = F.lit('{"metricDescriptors":[{"metricsIndex":0,"key":"directHeartRate"}],"activityDetailMetrics":[{"metrics":[1.0]}]}')
    old = texts.filter(block % 3 != 1).withColumn("raw_text", F.when(block % 5 == 0, stale).otherwise(F.col("raw_text")))
    table.append(parse_rows(old), 1)
    table.compact(1)
    table.append(parse_rows(texts.filter((block % 3 == 1) | (block % 5 == 0))), 2)
    table.compact(2)
    model = StoredModel(f"{root}/cardio", ["activity_id"], ["natural_key"], lambda rows: samples.cardio(samples.series_from_envelope(rows)))
    model.refresh(table.changes(None, 1))
    model.refresh(table.changes(1, 2))
    return _utc(model.read(spark), "recorded_at")


@query
def import_models_join(spark, sf):
    """Two imported relations, joined in SQL under their aliases."""
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("orders", "customer")]
    import_models([payloads.table(spark, sf, "orders"), payloads.table(spark, sf, "customer")], names, spark)
    return spark.sql(
        f"""
        SELECT c.c_nationkey, count(*) AS num_orders, min(o.o_orderkey) AS first_order
        FROM {names[0]} o JOIN {names[1]} c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey
        """
    )


@query
def today_in_zone(spark, sf):
    """The date in three zones at the instant of every event, read as UTC."""
    at = F.convert_timezone(F.lit("UTC"), F.expr("current_timezone()"), F.col("ts")).cast("timestamp")
    zones = {"los_angeles": "America/Los_Angeles", "kolkata": "Asia/Kolkata", "utc": "UTC"}
    return payloads.table(spark, sf, "events").select("event_id", *[today_in(z, at).alias(n) for n, z in zones.items()])


@query
def stream_land(spark, sf):
    """Events landed as a file stream, then read back as the latest row per key.

    Rows are ordered by their own time, so neither the number of files nor the
    order in which the stream takes them matters.
    """
    root = shared_dir(spark, "stream-land")
    table = LandedTable(spark, f"{root}/events", SUBJECT_KEYS)
    schema = payloads.table(spark, sf, "events").schema
    # A pattern, so that the table may be one file or a folder of files.
    stream = payload_stream(spark, f"{sf}/event[s].parquet", schema, fmt="parquet")

    def to_rows(batch: DataFrame, batch_seq: int) -> DataFrame:
        staged = stage_rows(
            batch.withColumn("subject_id", F.col("user_id")),
            key=F.col("event_type"),
            payload=F.struct("value", F.get_json_object("props", "$.k").cast("int").alias("k")),
            source_method="get_events",
            extracted_at=F.col("ts"),
            batch_seq=batch_seq,
            row_seq=F.col("event_id"),
        )
        return parse_rows(staged)

    land_stream(stream, to_rows, table, f"{root}/checkpoint").awaitTermination()
    return _show_event(table.current())


@query
def stream_dedupe(spark, sf):
    """Events as a stream in which files come again, in one micro-batch and after a restart, and one comes late: rows landed by key."""
    root = shared_dir(spark, "stream-dedupe")
    table = LandedTable(spark, f"{root}/events", SUBJECT_KEYS)
    events = payloads.table(spark, sf, "events")
    inbox = f"{root}/inbox"

    def put(*thirds: int) -> None:
        for n in thirds:
            events.filter(F.col("event_id") % 3 == n).write.mode("append").parquet(inbox)

    def to_rows(batch: DataFrame, batch_seq: int) -> DataFrame:
        staged = stage_rows(
            batch.withColumn("subject_id", F.col("user_id")),
            key=F.col("event_type"),
            payload=F.struct("value", F.get_json_object("props", "$.k").cast("int").alias("k")),
            source_method="get_events",
            extracted_at=F.col("ts"),
            batch_seq=batch_seq,
            row_seq=F.col("event_id"),
        )
        return parse_rows(staged)

    for thirds in ((0, 1, 0), (1, 2, 0)):
        put(*thirds)
        stream = without_replays(payload_stream(spark, inbox, events.schema, fmt="parquet"), events.columns)
        land_stream(stream, to_rows, table, f"{root}/checkpoint").awaitTermination()
    return table.log().groupBy(*SUBJECT_KEYS).agg(F.count(F.lit(1)).alias("rows_landed"), F.max("row_seq").alias("last_event"))


@query
def quarantine_redrive(spark, sf):
    """Error events land broken, most can be mended later: they take their old place in time, and later events still win."""
    rows = _event_payloads(spark, sf)
    text = F.to_json("payload")
    broken = (
        F.when(F.col("event_type") != "error", text).when(F.col("event_id") % 5 == 0, F.substring(text, 1, 9)).otherwise(F.concat(F.lit("{"), text))
    )
    table = LandedTable(spark, f"{shared_dir(spark, 'quarantine-redrive')}/events", ("subject_id",))
    for batch_seq, half in ((1, "event_id % 2 = 0"), (2, "event_id % 2 = 1")):
        staged = stage_rows(
            rows.filter(half), key=F.col("event_type"), payload=broken, source_method="get_events", extracted_at=payloads.EXTRACTED_AT,
            batch_seq=batch_seq, row_seq=F.col("event_id"), payload_is_json=True,
        )
        table.append(parse_rows(staged, strict=False), batch_seq)
    table.compact(2)
    mended = F.regexp_replace("rejected_text", r"^\{\{", "{")
    for run in (1, 1, 2):  # a run is repeated, and one finds nothing new
        table.redrive(mended, run)
    table.compact(3)
    raw = F.col("raw_data")
    last = table.current().select(
        F.lit("current").alias("part"), "subject_id", "natural_key", paths.as_float(raw, "$.value").alias("value"), F.col("row_seq").alias("event_id")
    )
    left = table.still_rejected(["subject_id", "natural_key"])
    left = left.select(F.lit("broken").alias("part"), "subject_id", "natural_key", F.lit(None).cast("double").alias("value"), F.col("row_seq").alias("event_id"))
    return last.unionByName(left)


@query
def payload_drift(spark, sf):
    """What the payloads of all staged collectors hold beside, or other than, what staging reads; steps change their format on 20 January."""
    days = payloads.user_days(spark, sf)
    changed = F.regexp_replace("payload", r'"totalSteps":(\d+)', r'"totalSteps":"$1","pushes":{"count":$1}')
    landed = []
    for name in ("STEPS", "BODY_BATTERY", "HRV", "RESTING_HEART_RATE", "SLEEP"):
        fetched = payloads.day_payloads(spark, sf, name, days)
        if name == "STEPS":
            late = F.col("requested") >= F.lit("2024-01-20").cast("date")
            fetched = fetched.withColumn("payload", F.when(late, changed).otherwise(F.col("payload")))
        landed.append(normalize.normalize_daily(fetched).withColumn("collector_name", F.lit(name)))
    for name in ("BODY_BATTERY_EVENTS", "TRAINING_READINESS"):
        landed.append(normalize.normalize_daily(payloads.sync_payloads(spark, sf, name)).withColumn("collector_name", F.lit(name)))
    landed += [payloads.activities(spark, sf).withColumn("collector_name", F.lit("ACTIVITIES"))]
    landed += [payloads.activity_details(spark, sf).withColumn("collector_name", F.lit("ACTIVITY_DETAILS"))]
    every = reduce(DataFrame.unionByName, [rows.select("collector_name", "raw_data") for rows in landed])
    specs = {model.upper(): [(f.path, f.kind) for f in fields] for model, fields in staging.MODELS.items()}
    return drift.payload_drift(every, specs)


# Semi-structured projections


@query
def json_paths_typed(spark, sf):
    raw = F.col("raw_data")
    return payloads.activities(spark, sf).select(
        "natural_key",
        paths.as_string(raw, "$.activityName").alias("top_level"),
        paths.as_string(raw, "$.activityType.typeKey").alias("nested"),
        paths.as_string(raw, "$.locationName").alias("sometimes_missing"),
        paths.as_string(raw, "$.nowhere.at.all").alias("never_there"),
        paths.as_int(raw, "$.calories").alias("rounded_number"),
        paths.as_int(raw, "$.maxHR").alias("rounded_text"),
        paths.as_float(raw, "$.distance").alias("number"),
        paths.as_boolean(raw, "$.favorite").alias("flag"),
        paths.as_date(raw, "$.startTimeLocal").alias("day"),
        paths.as_local_timestamp(raw, "$.startTimeLocal").cast("timestamp_ntz").alias("moment"),
    )


def _sync_rows(spark, sf, collector: str) -> DataFrame:
    return to_envelope(
        normalize.normalize_daily(payloads.sync_payloads(spark, sf, collector)),
        extracted_at=payloads.EXTRACTED_AT,
    )


def _day_rows(spark, sf, collector: str, days: DataFrame | None = None) -> DataFrame:
    return to_envelope(
        normalize.normalize_daily(payloads.day_payloads(spark, sf, collector, days)),
        extracted_at=payloads.EXTRACTED_AT,
    )


@query
def array_first_snapshot(spark, sf):
    raw = F.col("raw_data")
    return _sync_rows(spark, sf, "TRAINING_READINESS").select(
        *SUBJECT_KEYS,
        paths.as_string(raw, "$[0].level").alias("newest_level"),
        paths.as_int(raw, "$[0].score").alias("newest_score"),
        paths.as_string(raw, "$[5].level").alias("sixth_level"),
    )


@query
def nested_map_first(spark, sf):
    value = paths.as_int(F.col("raw_data"), "$.allMetrics.metricsMap.WELLNESS_RESTING_HEART_RATE[0].value")
    return _day_rows(spark, sf, "RESTING_HEART_RATE").select(*SUBJECT_KEYS, value.alias("resting_heart_rate"))


@query
def array_size_daily(spark, sf):
    raw = F.col("raw_data")
    return _sync_rows(spark, sf, "BODY_BATTERY_EVENTS").select(
        *SUBJECT_KEYS,
        paths.array_size(raw).alias("num_events"),
        paths.array_size(raw, "$[0]").alias("size_of_object"),
    )


@query
def epoch_ms_ntz(spark, sf):
    raw = F.col("raw_data")
    return _day_rows(spark, sf, "SLEEP").select(
        *SUBJECT_KEYS,
        paths.epoch_ms_to_ntz(raw, "$.dailySleepDTO.sleepStartTimestampLocal").alias("started_at"),
        paths.epoch_ms_to_ntz(raw, "$.dailySleepDTO.sleepEndTimestampLocal").alias("ended_at"),
    )


# Staging models


@query
def stg_activities(spark, sf):
    return _wall_clock(staging.stage(payloads.activities(spark, sf), "activities"), "started_at")


@query
def stg_activity_details(spark, sf):
    staged = staging.stage(payloads.activity_details(spark, sf), "activity_details")
    return staged.drop("metric_descriptors", "activity_detail_metrics")


@query
def subtree_passthrough(spark, sf):
    """The sub-trees that staged details carry on, as JSON text."""
    staged = staging.stage(payloads.activity_details(spark, sf), "activity_details")
    return staged.select(
        "activity_id",
        F.to_json("metric_descriptors").alias("metric_descriptors"),
        paths.as_float(F.col("activity_detail_metrics"), "$[0].metrics[0]").alias("first_value"),
        paths.array_size(F.col("activity_detail_metrics")).alias("num_samples"),
    )


@query
def stg_body_battery(spark, sf):
    staged = staging.stage(_day_rows(spark, sf, "BODY_BATTERY"), "body_battery")
    return _wall_clock(staged, "started_at", "ended_at")


@query
def stg_body_battery_events(spark, sf):
    return staging.stage(_sync_rows(spark, sf, "BODY_BATTERY_EVENTS"), "body_battery_events")


@query
def stg_hrv(spark, sf):
    return _wall_clock(staging.stage(_day_rows(spark, sf, "HRV"), "hrv"), "started_at", "ended_at")


@query
def stg_resting_heart_rate(spark, sf):
    return staging.stage(_day_rows(spark, sf, "RESTING_HEART_RATE"), "resting_heart_rate")


@query
def stg_sleep(spark, sf):
    return staging.stage(_day_rows(spark, sf, "SLEEP"), "sleep")


@query
def stg_steps(spark, sf):
    return staging.stage(_day_rows(spark, sf, "STEPS"), "steps")


@query
def stg_training_readiness(spark, sf):
    staged = staging.stage(_sync_rows(spark, sf, "TRAINING_READINESS"), "training_readiness")
    return _wall_clock(staged, "recorded_at")


@query
def stg_steps_current(spark, sf):
    """Steps staged from two landed batches, the second re-fetching from 13 January."""
    days = payloads.day_payloads(spark, sf, "STEPS")
    refetched = F.col("requested") >= F.lit("2024-01-13").cast("date")
    stale = F.col("requested") <= F.lit("2024-01-16").cast("date")
    # The first run saw the days before they were final.
    early = days.filter(stale).withColumn("payload", F.lit('{"stepGoal": 1, "totalSteps": 1}'))
    log = to_envelope(normalize.normalize_daily(early), extracted_at="2024-01-16T10:00:00Z", batch_seq=1).unionByName(
        to_envelope(normalize.normalize_daily(days.filter(refetched)), extracted_at="2024-02-01T10:00:00Z", batch_seq=2)
    )
    return staging.stage_current(log, "steps")


# Sample time series


def _series(spark, sf) -> DataFrame:
    return samples.series_from_envelope(payloads.activity_details(spark, sf))


def _long(spark, sf) -> DataFrame:
    return samples.unpivot(_series(spark, sf))


@query
def explode_descriptors(spark, sf):
    return samples.explode_descriptors(_series(spark, sf))


@query
def explode_samples(spark, sf):
    return samples.explode_samples(_series(spark, sf)).select(
        "activity_id",
        "sample_index",
        F.size("metrics").alias("num_metrics"),
        F.get("metrics", F.lit(0)).alias("first_metric"),
    )


@query
def samples_unpivoted(spark, sf):
    return _long(spark, sf)


@query
def samples_unpivoted_join(spark, sf):
    series = _series(spark, sf)
    return samples.unpivot_join(samples.explode_descriptors(series), samples.explode_samples(series))


@query
def surrogate_key(spark, sf):
    """Keys over an id, a NULL-able name and a number."""
    rows = payloads.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        "o_orderpriority",
    )
    return rows.select("o_orderkey", keys.surrogate_key("o_orderkey", "status", "o_orderpriority").alias("sk"))


@query
def cardio_pivot(spark, sf):
    return _utc(samples.cardio(_series(spark, sf)), "recorded_at")


@query
def cardio_pivot_long(spark, sf):
    return _utc(samples.cardio_long(_long(spark, sf)), "recorded_at")


@query
def gps_capable(spark, sf):
    return samples.gps_capable(_series(spark, sf))


@query
def gps_semi_join(spark, sf):
    """The long rows that the GPS pivot is made of: its metrics, of GPS-capable activities."""
    wanted = [samples.TIMESTAMP_KEY, *samples.GPS_METRICS.values()]
    return samples.gps_samples_long(_long(spark, sf)).filter(F.col("metric_key").isin(wanted))


@query
def gps_pivot(spark, sf):
    return _utc(samples.gps(_series(spark, sf)), "recorded_at")


@query
def gps_pivot_long(spark, sf):
    return _utc(samples.gps_long(_long(spark, sf)), "recorded_at")


@query
def hr_by_minute(spark, sf):
    return samples.heart_rate_by_minute(samples.cardio(_series(spark, sf)))


# Calendar


def _order_bounds(spark, sf) -> DataFrame:
    """First order day, and a year past the last one."""
    o = payloads.table(spark, sf, "orders")
    last = F.to_date(F.max("o_orderdate"))
    return o.agg(
        F.to_date(F.min("o_orderdate")).alias("start_date"),
        F.date_add(last, calendar.HORIZON_DAYS).alias("end_date"),
        last.alias("today"),
    )


@query
def date_spine(spark, sf):
    return calendar.date_spine(_order_bounds(spark, sf))


@query
def dim_dates(spark, sf):
    bounds = _order_bounds(spark, sf)
    return calendar.dim_dates(calendar.date_spine(bounds), bounds.select("today").scalar())


@query
def dates_spine_full(spark, sf):
    """Every column of the date dimension, of the days in the orders' calendar."""
    return calendar.describe_all(calendar.date_spine(_order_bounds(spark, sf)))


@query
def calendar_gap_days(spark, sf):
    """Days without an event between each user's first and last, with their calendar flags."""
    facts = payloads.events(spark, sf).select("user_id", "day")
    gaps = calendar.gap_days(facts, ["user_id"], "day")
    return calendar.dim_dates(gaps.select("date_day", "user_id"), F.lit(TODAY).cast("date"), keep=["user_id"]).select(
        "user_id", "date_day", "day_of_week_name_short", "week_start_date", "is_weekend"
    )


@query
def coverage_islands(spark, sf):
    """Each user's runs of days with events, and the gaps behind them."""
    facts = payloads.events(spark, sf).select("user_id", "day")
    return intervals.coverage_islands(facts, ["user_id"], "day")


@query
def open_intervals(spark, sf):
    """What a backfill over all days still has to ask for, once the days that landed are taken out, and its range chunks."""
    facts = payloads.events(spark, sf).select(F.col("user_id").alias("subject_id"), "day", "event_type")
    since, today = _event_days(spark, sf)
    # Errors landed as steps, and everything else as sleep.
    name = F.when(F.col("event_type") == "error", "STEPS").otherwise("SLEEP").alias("collector_name")
    keys = ["subject_id", "collector_name"]
    answered = intervals.coverage_islands(facts.select("subject_id", "day", name), keys, "day")
    none = facts.select("subject_id", name, F.lit(None).cast("date").alias("last_extracted_date")).filter("false")
    windows = watermarks.fetch_windows(facts.select("subject_id").distinct(), none, today, since, "sleep,steps")
    left = intervals.open_intervals(windows, answered, keys)
    return watermarks.chunk_ranges(left).select(*keys, "chunk_start", "chunk_end")


# Data tests


@query
def test_unique_failures(spark, sf):
    lines = payloads.table(spark, sf, "lineitem")
    return quality.unique_failures(lines, "l_orderkey", "l_linenumber")


@query
def test_not_null_failures(spark, sf):
    return quality.not_null_failures(_long(spark, sf), "metric_value")


@query
def data_test_report(spark, sf):
    """Both tests on the key of every model, and on a key known to repeat."""
    root = shared_dir(spark, "data-test-report")
    payloads.user_days(spark, sf).write.parquet(f"{root}/days")
    landed = _landed(spark, sf, spark.read.parquet(f"{root}/days"))
    landed["activity_details"].write.parquet(f"{root}/activity_details")  # read by a model and the series
    landed["activity_details"] = spark.read.parquet(f"{root}/activity_details")
    samples.series_from_envelope(landed["activity_details"]).write.parquet(f"{root}/series")
    series = spark.read.parquet(f"{root}/series")
    models = project.build_models(landed, _order_bounds(spark, sf), F.lit(TODAY).cast("date"), series=series)
    lines = payloads.table(spark, sf, "lineitem")
    repeated = quality.data_test_report({"lineitem": (lines, ["l_orderkey", "l_linenumber"])})
    return project.test_models(models).unionByName(repeated)


def _landed(spark, sf, days: DataFrame) -> dict[str, DataFrame]:
    """An envelope table for every staging model; those of days share the stored summaries."""
    return {
        "activities": payloads.activities(spark, sf),
        "activity_details": payloads.activity_details(spark, sf),
        **{m: _day_rows(spark, sf, m.upper(), days) for m in ("body_battery", "hrv", "resting_heart_rate", "sleep", "steps")},
        **{m: _sync_rows(spark, sf, m.upper()) for m in ("body_battery_events", "training_readiness")},
    }


@query
def steps_by_weekday(spark, sf):
    """SQL over published models: the steps fact on the date dimension."""
    steps = {"steps": _day_rows(spark, sf, "STEPS")}
    bounds = payloads.events(spark, sf).agg(
        F.min("day").alias("start_date"), F.date_add(F.max("day"), calendar.HORIZON_DAYS).alias("end_date")
    )
    own = uuid.uuid4().hex  # views of this call alone
    project.publish(project.build_models(steps, bounds, F.lit(TODAY).cast("date")), rename=lambda name: f"{name}_{own}")
    return spark.sql(
        f"""
        SELECT month_name, day_of_week_name, is_weekend, count(*) AS num_days,
               sum(total_steps) AS total_steps, max(step_goal) AS top_goal
        FROM stg_steps_{own} JOIN dim_dates_{own} ON steps_date = date_day
        GROUP BY month_name, day_of_week_name, is_weekend
        """
    )
