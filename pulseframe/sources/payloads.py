"""Wellness payloads derived from the test tables.

These recipes turn rows of ``events`` and ``orders`` into the JSON a wellness
service would return, so the operators can be run and checked on given data.
Every array is built from a group of proven size: a block of consecutive event
ids, or the days of one chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators.watermarks import MAX_RANGE_DAYS
from pulseframe.session import shuffle_partitions
from pulseframe.sources.envelope import parse_rows, stage_rows
from pulseframe.sources.registry import DAILY_METHODS, KEYED_METHODS, RANGE_METHODS

EXTRACTED_AT = "2024-02-01T02:00:00+00:00"
# event_id is the primary key of events, so a block holds at most this many rows.
SAMPLES_PER_ACTIVITY = 100
EVENTS_PER_SYNC = 48

_LOCAL_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with epoch milliseconds, day, and the number inside ``props``."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        paths.ntz_to_ms(F.col("ts")).alias("ms"),
        F.to_date("ts").alias("day"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


# Activities


def activity_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One activity per order; fields go missing with the order status."""
    o = table(spark, sf_dir, "orders").repartition(shuffle_partitions(spark))
    price, number = F.col("o_totalprice"), F.col("o_orderkey")
    pending, open_ = F.col("o_orderstatus") == "P", F.col("o_orderstatus") == "O"
    payload = F.struct(
        F.col("o_custkey").alias("deviceId"),
        F.concat(F.lit("Order "), number).alias("activityName"),
        F.struct(F.col("o_orderpriority").alias("typeKey")).alias("activityType"),
        F.struct(F.col("o_orderstatus").alias("typeKey")).alias("eventType"),
        F.when(~pending, F.concat(F.lit("Site "), F.col("o_custkey"))).alias("locationName"),
        price.alias("distance"),
        (price / 10).alias("duration"),
        (price / 8).alias("elapsedDuration"),
        F.when(~open_, price / 16).alias("movingDuration"),
        price.alias("calories"),
        (F.lit(60) + number % 100).alias("averageHR"),
        (number / 2).cast("string").alias("maxHR"),
        (price / 1000).alias("averageSpeed"),
        (price / 500).alias("maxSpeed"),
        (number * 0.5).alias("elevationGain"),
        (number * -0.25).alias("elevationLoss"),
        (F.col("o_orderstatus") == "F").alias("favorite"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("startTimeLocal"),
    )
    return stage_rows(
        o,
        key=number,
        payload=payload,
        source_method=KEYED_METHODS["ACTIVITIES"],
        extracted_at=EXTRACTED_AT,
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rows(activity_payloads(spark, sf_dir))


def _descriptors(*metrics: tuple[int, str, str]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("metricsIndex"),
                F.lit(key).alias("key"),
                F.struct(F.lit(unit).alias("key")).alias("unit"),
            )
            for i, key, unit in metrics
        ]
    )


def activity_detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One activity per block of 100 events, in three layouts.

    Layout 0 has no GPS. Layout 2 declares a metric at a position no sample
    has. Heart rate is NULL for error events.
    """
    block = F.expr(f"event_id div {SAMPLES_PER_ACTIVITY}")
    heart_rate = F.when(F.col("event_type") != "error", F.col("value")).alias("hr")
    grouped = (
        events(spark, sf_dir)
        .repartition(shuffle_partitions(spark), block)
        .groupBy(block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "ms", heart_rate, "k"))).alias("rows"))
        .withColumn("layout", F.col("block") % 3)
    )
    start = F.element_at("rows", 1)["ms"]

    def sample(row: Column) -> Column:
        ms, hr, k = row["ms"].cast("double"), row["hr"], row["k"].cast("double")
        elapsed = (row["ms"] - start) / 1000
        distance = (row["event_id"] % SAMPLES_PER_ACTIVITY) * 12.5
        values = (
            F.when(F.col("layout") == 0, F.array(hr, ms, elapsed))
            .when(F.col("layout") == 1, F.array(ms, k - 50, hr, elapsed, k * 1.5, hr / 10, distance))
            .otherwise(F.array(elapsed, k - 50, k * 2, ms, hr, k / 4, elapsed))
        )
        return F.struct(values.alias("metrics"))

    descriptors = (
        F.when(
            F.col("layout") == 0,
            _descriptors((0, "directHeartRate", "bpm"), (1, "directTimestamp", "gmt"), (2, "sumElapsedDuration", "second")),
        )
        .when(
            F.col("layout") == 1,
            _descriptors(
                (0, "directTimestamp", "gmt"),
                (1, "directLatitude", "dd"),
                (2, "directHeartRate", "bpm"),
                (3, "sumElapsedDuration", "second"),
                (4, "directLongitude", "dd"),
                (5, "directSpeed", "mps"),
                (6, "sumDistance", "meter"),
            ),
        )
        .otherwise(
            _descriptors(
                (0, "sumElapsedDuration", "second"),
                (1, "directLatitude", "dd"),
                (2, "directElevation", "meter"),
                (3, "directTimestamp", "gmt"),
                (4, "directHeartRate", "bpm"),
                (5, "directVerticalSpeed", "mps"),
                (6, "sumMovingDuration", "second"),
                (99, "directBodyBattery", "dimensionless"),
            )
        )
    )
    payload = F.struct(
        F.size(descriptors).alias("measurementCount"),
        F.size("rows").alias("metricsCount"),
        (F.size("rows") + F.col("layout")).alias("totalMetricsCount"),
        (F.col("layout") == 0).alias("pendingData"),
        F.lit(True).alias("detailsAvailable"),
        descriptors.alias("metricDescriptors"),
        F.transform("rows", sample).alias("activityDetailMetrics"),
    )
    return stage_rows(
        grouped,
        key=F.col("block"),
        payload=payload,
        source_method=KEYED_METHODS["ACTIVITY_DETAILS"],
        extracted_at=EXTRACTED_AT,
    )


def activity_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rows(activity_detail_payloads(spark, sf_dir))


# Daily and range payloads


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row per user and day, from aggregates that combine before the shuffle."""
    return (
        events(spark, sf_dir)
        .groupBy(F.col("user_id").alias("subject_id"), "day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchase"),
            F.sum("k").alias("sum_k"),
            F.max("value").alias("max_value"),
            F.min("value").alias("min_value"),
            F.min("ms").alias("first_ms"),
            F.max("ms").alias("last_ms"),
        )
    )


def _local_text(ms: Column) -> Column:
    return F.date_format(paths.ms_to_ntz(ms), _LOCAL_TEXT)


def _window_fields() -> list[Column]:
    return [
        _local_text(F.col("first_ms")).alias("startTimestampLocal"),
        _local_text(F.col("last_ms")).alias("endTimestampLocal"),
    ]


def _steps() -> Column:
    return F.struct(
        F.col("day").alias("calendarDate"),
        (F.col("n") + 0.5).alias("stepGoal"),
        (F.col("sum_k") * 1.25).alias("totalDistance"),
        F.col("sum_k").alias("totalSteps"),
    )


def _body_battery() -> Column:
    return F.struct(
        F.col("day").alias("date"),
        (F.col("sum_k") / 2).alias("charged"),
        (F.col("sum_k") / -2).alias("drained"),
        *_window_fields(),
    )


def _hrv() -> Column:
    summary = F.struct(
        F.when(F.col("n") > 2, F.lit("BALANCED")).otherwise(F.lit("LOW")).alias("status"),
        (F.col("n") + 20).alias("lastNightAvg"),
        F.when(F.col("n") > 1, F.col("sum_k")).alias("weeklyAvg"),
        F.col("max_value").alias("lastNight5MinHigh"),
    )
    return F.struct(summary.alias("hrvSummary"), *_window_fields())


def _resting_heart_rate() -> Column:
    reading = F.array(F.struct((F.col("n") + 40).alias("value")))
    readings = F.when(F.col("n") > 1, reading).otherwise(F.slice(reading, 1, 0))
    return F.struct(
        F.struct(F.struct(readings.alias("WELLNESS_RESTING_HEART_RATE")).alias("metricsMap")).alias("allMetrics")
    )


def _sleep() -> Column:
    summary = F.struct(
        ((F.col("last_ms") - F.col("first_ms")) / 1000).alias("sleepTimeSeconds"),
        (F.col("n") * 60).alias("deepSleepSeconds"),
        F.when(F.col("n_purchase") > 0, F.col("n_purchase") * 90).alias("lightSleepSeconds"),
        F.col("sum_k").alias("remSleepSeconds"),
        F.col("min_value").alias("awakeSleepSeconds"),
        F.lit(0).alias("napTimeSeconds"),
        (F.col("n") > 2).alias("retro"),
        F.when(F.col("n") > 1, F.lit("true")).otherwise(F.lit("false")).alias("sleepWindowConfirmed"),
        F.col("first_ms").alias("sleepStartTimestampLocal"),
        F.when(F.col("n") > 1, F.col("last_ms")).alias("sleepEndTimestampLocal"),
    )
    return F.struct(summary.alias("dailySleepDTO"))


_DAY_PAYLOADS = {
    "STEPS": _steps,
    "BODY_BATTERY": _body_battery,
    "HRV": _hrv,
    "RESTING_HEART_RATE": _resting_heart_rate,
    "SLEEP": _sleep,
}


def _method(name: str) -> Column:
    return F.lit({**RANGE_METHODS, **DAILY_METHODS}[name])


def day_payloads(spark: SparkSession, sf_dir: str, collector: str, days: DataFrame | None = None) -> DataFrame:
    """A payload per user and day: ``(subject_id, requested, payload, source_method)``.

    ``days`` may be stored :func:`user_days` that several collectors share.
    """
    return (user_days(spark, sf_dir) if days is None else days).select(
        "subject_id",
        F.col("day").alias("requested"),
        F.to_json(_DAY_PAYLOADS[collector]()).alias("payload"),
        _method(collector).alias("source_method"),
    )


def sync_payloads(spark: SparkSession, sf_dir: str, collector: str) -> DataFrame:
    """List payloads, newest entry first, per block of 48 events and day."""
    e = events(spark, sf_dir)
    if collector == "BODY_BATTERY_EVENTS":
        entry = F.struct("event_id", F.col("event_type").alias("eventType"), F.col("k").alias("impact"))
    elif collector == "TRAINING_READINESS":
        entry = F.struct(
            "event_id",
            F.col("event_type").alias("level"),
            F.when(F.col("k") >= 10, F.concat(F.lit("short "), "k")).alias("feedbackShort"),
            F.concat(F.lit("long "), "k").alias("feedbackLong"),
            F.col("value").alias("score"),
            (F.col("k") * 3).alias("acuteLoad"),
            (F.col("k") / 2).alias("recoveryTime"),
            F.when(F.col("k") < 90, F.col("k")).alias("sleepScore"),
            (F.col("k") + 1).alias("hrvWeeklyAverage"),
            (F.col("k") > 50).alias("validSleep"),
            _local_text(F.col("ms")).alias("timestampLocal"),
        )
    else:
        raise ValueError(f"{collector} has no list payload")
    sync = F.expr(f"event_id div {EVENTS_PER_SYNC}")
    return (
        e.repartition(shuffle_partitions(spark), sync)
        .groupBy(sync.alias("subject_id"), F.col("day").alias("requested"))
        .agg(F.sort_array(F.collect_list(entry), asc=False).alias("entries"))
        .select(
            "subject_id",
            "requested",
            F.to_json("entries").alias("payload"),
            _method(collector).alias("source_method"),
        )
    )


def range_payloads(spark: SparkSession, sf_dir: str, first_day: str = "2024-01-01") -> DataFrame:
    """A payload per user and 27-day chunk: a list of at most 27 day items.

    One-day chunks come as a bare object. Chunks without a busy day are answered
    twice, once with an empty list. Which date field an item carries depends on
    its event count.
    """
    origin = F.lit(first_day).cast("date")
    chunk = F.floor(F.datediff("day", origin) / MAX_RANGE_DAYS).cast("int")
    n, day = F.col("n"), F.col("day").cast("string")
    item = F.struct(
        F.col("day").alias("sort_day"),
        F.when(n == 2, F.lit("")).when(n > 3, day).alias("calendarDate"),
        F.when(n == 2, day).alias("date"),
        F.when(n == 3, day).alias("summaryDate"),
        F.col("sum_k").alias("totalSteps"),
    )
    chunks = (
        user_days(spark, sf_dir)
        .groupBy("subject_id", F.date_add(origin, chunk * MAX_RANGE_DAYS).alias("chunk_start"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"), F.max("n").alias("busiest"))
        .select(
            "subject_id",
            "chunk_start",
            F.when(F.size("items") == 1, F.to_json(F.element_at("items", 1)))
            .otherwise(F.to_json("items"))
            .alias("found"),
            (F.col("busiest") == 1).alias("quiet"),
        )
    )
    answers = F.when(F.col("quiet"), F.array("found", F.lit("[]"))).otherwise(F.array("found"))
    return chunks.select("subject_id", "chunk_start", F.explode(answers).alias("payload"), _method("STEPS").alias("source_method"))
