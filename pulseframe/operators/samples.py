"""Self-describing sample arrays to long and wide time series.

An activity's payload declares, per metric, the position its values take in
every sample (``metricDescriptors``), and holds the samples
(``activityDetailMetrics``). Layouts differ between activities. Both arrays sit
on one row, so a value is looked up on that row: no join, no shuffle, and no
group whose size depends on an activity.

The ``*_long`` functions work from the long table alone, for callers that no
longer have the payloads; they shuffle and spread hot activities by sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.functions.keys import surrogate_key

DESCRIPTOR_TYPE = "array<struct<metricsIndex:int,key:string,unit:struct<key:string>>>"
# As read: a position is rounded like every other integer before it becomes one.
READ_DESCRIPTOR_TYPE = DESCRIPTOR_TYPE.replace("metricsIndex:int", "metricsIndex:decimal(38,0)")
SAMPLE_TYPE = "array<struct<metrics:array<double>>>"

# Metric keys behind the wide columns.
TIMESTAMP_KEY = "directTimestamp"
CARDIO_METRICS = {
    "elapsed_seconds": "sumElapsedDuration",
    "moving_seconds": "sumMovingDuration",
    "distance_meters": "sumDistance",
    "heart_rate_bpm": "directHeartRate",
    "body_battery": "directBodyBattery",
}
GPS_SCOPE_KEY = "directLatitude"
GPS_METRICS = {
    "latitude": "directLatitude",
    "longitude": "directLongitude",
    "elevation_meters": "directElevation",
    "speed_mps": "directSpeed",
    "vertical_speed_mps": "directVerticalSpeed",
}

SALTS = 64  # slices a hot activity is spread over in the long forms


def _ids(df: DataFrame) -> list[str]:
    return [c for c in ("subject_id", "activity_id") if c in df.columns]


def series_from_envelope(details: DataFrame, strict: bool = True) -> DataFrame:
    """Activity id plus typed descriptor and sample arrays, read straight from the payload.

    Typed paths are pushed into a Parquet scan, so nothing else of the payload
    is read. Strict extraction fails on a sample value that is no number;
    lenient extraction reads it as NULL (:func:`malformed` finds such payloads).
    Activity ids must be unique: pass the table through ``latest_by_key`` first
    if it may hold several versions.
    """
    get = F.variant_get if strict else F.try_variant_get
    subject = ["subject_id"] if "subject_id" in details.columns else []
    return details.select(
        *subject,
        F.col("natural_key").alias("activity_id"),
        get("raw_data", "$.metricDescriptors", READ_DESCRIPTOR_TYPE).cast(DESCRIPTOR_TYPE).alias("descriptors"),
        get("raw_data", "$.activityDetailMetrics", SAMPLE_TYPE).alias("samples"),
    )


def series_from_staging(staged: DataFrame, strict: bool = True) -> DataFrame:
    """As :func:`series_from_envelope`, from the staging model's pass-through columns."""
    get = F.variant_get if strict else F.try_variant_get
    return staged.select(
        *_ids(staged),
        get("metric_descriptors", "$", READ_DESCRIPTOR_TYPE).cast(DESCRIPTOR_TYPE).alias("descriptors"),
        get("activity_detail_metrics", "$", SAMPLE_TYPE).alias("samples"),
    )


def malformed(details: DataFrame) -> DataFrame:
    """Landed detail rows that strict extraction rejects: no arrays, or sample values that are no numbers."""

    def present(v: Column) -> Column:
        return v.isNotNull() & ~F.is_variant_null(v)

    def not_an_array(path: str) -> Column:
        return present(F.try_variant_get("raw_data", path, "variant")) & paths.items("raw_data", path).isNull()

    def bad_value(v: Column) -> Column:
        return present(v) & F.try_variant_get(v, "$", "double").isNull()

    bad_sample = F.exists(
        paths.items("raw_data", "$.activityDetailMetrics"),
        lambda s: F.coalesce(F.exists(paths.items(s, "$.metrics"), bad_value), F.lit(False)),
    )
    return details.filter(
        not_an_array("$.metricDescriptors") | not_an_array("$.activityDetailMetrics") | F.coalesce(bad_sample, F.lit(False))
    )


def _listed(column: str, kind: str) -> Column:
    """The array, or an empty one.

    Kept an expression: given a bare column, Spark infers a "not empty" filter
    and evaluates it below the extraction, parsing every payload once more.
    """
    return F.coalesce(F.col(column), F.array().cast(kind))


def explode_descriptors(series: DataFrame) -> DataFrame:
    """One row per declared metric: its position, key and unit."""
    declared = F.explode(_listed("descriptors", DESCRIPTOR_TYPE))
    return series.select(*_ids(series), declared.alias("d")).select(
        *_ids(series),
        F.col("d.metricsIndex").alias("metrics_index"),
        F.col("d.key").alias("metric_key"),
        F.col("d.unit.key").alias("metric_unit"),
    )


def explode_samples(series: DataFrame) -> DataFrame:
    """One row per sample: its 0-based index and positional values."""
    numbered = F.posexplode(_listed("samples", SAMPLE_TYPE))
    return series.select(*_ids(series), numbered.alias("sample_index", "s")).select(
        *_ids(series), "sample_index", F.col("s.metrics").alias("metrics")
    )


def unpivot(series: DataFrame) -> DataFrame:
    """Long form: one row per activity, sample and declared metric.

    A position past the end of a sample, or a NULL value, keeps its row.
    """
    ids = _ids(series)
    numbered = F.posexplode(_listed("samples", SAMPLE_TYPE)).alias("sample_index", "s")
    per_metric = series.select(*ids, "descriptors", numbered).select(
        *ids, "sample_index", F.col("s.metrics").alias("metrics"), F.inline(_listed("descriptors", DESCRIPTOR_TYPE))
    )
    long = per_metric.select(
        *ids,
        "sample_index",
        F.col("key").alias("metric_key"),
        F.col("unit.key").alias("metric_unit"),
        F.get("metrics", F.col("metricsIndex")).alias("metric_value"),
    )
    sk = surrogate_key(*ids, "sample_index", "metric_key").alias("sk")
    return long.select(sk, *long.columns)


def unpivot_join(descriptors: DataFrame, samples: DataFrame, salts: int = SALTS) -> DataFrame:
    """Long form when descriptors and samples live in different tables.

    A join on the activity. Samples of one activity are spread over ``salts``
    slices by their index and the (few) descriptors repeated per slice.
    """
    ids = _ids(samples)
    slices = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    left = samples.withColumn("_salt", F.pmod("sample_index", F.lit(salts)))
    long = left.join(descriptors.select("*", slices), [*ids, "_salt"]).select(
        *ids,
        "sample_index",
        "metric_key",
        "metric_unit",
        F.get("metrics", "metrics_index").alias("metric_value"),
    )
    sk = surrogate_key(*ids, "sample_index", "metric_key").alias("sk")
    return long.select(sk, *long.columns)


def _positions(key: str) -> Column:
    """Positions the activity declares for a metric: normally one, possibly none or several."""
    declared = F.filter("descriptors", lambda d: d["key"] == key)
    return F.transform(declared, lambda d: d["metricsIndex"])


def _wide(series: DataFrame, metrics: dict[str, str], keep: Column) -> DataFrame:
    """One row per sample of the activities in ``keep``, with a column per wanted metric.

    All array functions run once per activity, before samples are exploded; a
    sample then costs one generated array access per metric. A metric declared
    several times takes its largest value, settled per activity as well.
    """
    ids = _ids(series)
    wanted = {"recorded_at_epoch_ms": TIMESTAMP_KEY, **metrics}
    found = series.select(*ids, "descriptors", "samples", *[_positions(k).alias(f"_{n}") for n, k in wanted.items()])

    def largest(name: str) -> Column:
        positions = F.col(f"_{name}")
        per_sample = F.transform(
            "samples", lambda s: F.array_max(F.transform(positions, lambda i: F.get(s["metrics"], i)))
        )
        return F.when(F.size(positions) > 1, per_sample)

    located = found.select(
        *ids,
        *[F.get(f"_{n}", F.lit(0)).alias(f"_at_{n}") for n in wanted],
        *[largest(n).alias(f"_max_{n}") for n in wanted],
        # Not a filter: it would be evaluated below the extraction, see _listed.
        F.when(keep, F.col("samples")).alias("samples"),
    )
    numbered = F.posexplode(_listed("samples", SAMPLE_TYPE)).alias("sample_index", "s")
    slots = [c for c in located.columns if c != "samples"]
    exploded = located.select(*slots, numbered)

    def value(name: str) -> Column:
        declared_twice = F.col(f"_max_{name}")
        return F.when(declared_twice.isNotNull(), F.get(declared_twice, F.col("sample_index"))).otherwise(
            F.get("s.metrics", F.col(f"_at_{name}"))
        )

    return exploded.select(*ids, "sample_index", *[value(n).alias(n) for n in wanted])


def _finish(wide: DataFrame, metrics: dict[str, str]) -> DataFrame:
    ids = _ids(wide)
    return wide.select(
        surrogate_key(*ids, "sample_index").alias("sk"),
        *ids,
        "sample_index",
        *metrics,
        paths.ms_to_instant(F.col("recorded_at_epoch_ms")).alias("recorded_at"),
    )


def cardio(series: DataFrame) -> DataFrame:
    """Heart rate, body battery, duration and distance per sample, for every activity.

    Activities without any of these metrics keep their samples, all NULL;
    activities that declare no metric at all have no rows.
    """
    return _finish(_wide(series, CARDIO_METRICS, F.size("descriptors") > 0), CARDIO_METRICS)


def is_gps_capable() -> Column:
    """True when the activity declares latitude, even if every value is NULL."""
    return F.exists("descriptors", lambda d: d["key"] == GPS_SCOPE_KEY)


def gps(series: DataFrame) -> DataFrame:
    """Position, elevation and speed per sample, for GPS-capable activities."""
    return _finish(_wide(series, GPS_METRICS, is_gps_capable()), GPS_METRICS)


def gps_capable(series: DataFrame) -> DataFrame:
    """Ids of activities that declare latitude and have samples.

    Marked by expression: a filter would sink below the extraction and parse each payload again.
    """
    row = F.array(F.struct(*_ids(series)))
    capable = F.coalesce(is_gps_capable() & (F.size("samples") > 0), F.lit(False))
    return series.select(F.inline(F.when(capable, row).otherwise(F.slice(row, 2, 1))))


# Forms over the long table.


def pivot_long(long: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Wide samples from the long table. Groups are single samples, so none is large."""
    ids = _ids(long)
    wanted = {"recorded_at_epoch_ms": TIMESTAMP_KEY, **metrics}
    value = {n: F.max(F.when(F.col("metric_key") == k, F.col("metric_value"))) for n, k in wanted.items()}
    wide = long.groupBy(*ids, "sample_index").agg(*[c.alias(n) for n, c in value.items()])
    return _finish(wide, metrics)


def gps_capable_long(long: DataFrame) -> DataFrame:
    """Distinct ids having a latitude row."""
    return long.filter(F.col("metric_key") == GPS_SCOPE_KEY).select(*_ids(long)).distinct()


def gps_samples_long(long: DataFrame, salts: int = SALTS) -> DataFrame:
    """Long rows of GPS-capable activities: a semi join salted by sample index.

    Adaptive execution turns it into a broadcast join when the id list proves
    small; otherwise a hot activity is spread over ``salts`` join tasks.
    """
    ids = _ids(long)
    slices = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    capable = gps_capable_long(long).select("*", slices)
    salted = long.withColumn("_salt", F.pmod("sample_index", F.lit(salts)))
    return salted.join(capable, [*ids, "_salt"], "left_semi").select(*long.columns)


def gps_long(long: DataFrame, salts: int = SALTS) -> DataFrame:
    """:func:`gps` computed from the long table."""
    return pivot_long(gps_samples_long(long, salts), GPS_METRICS)


def cardio_long(long: DataFrame) -> DataFrame:
    """:func:`cardio` computed from the long table."""
    return pivot_long(long, CARDIO_METRICS)


def heart_rate_by_minute(cardio_samples: DataFrame) -> DataFrame:
    """Average and peak heart rate per activity and elapsed minute.

    The sum is taken over whole millionths, so it does not depend on the order
    in which tasks finish; samples are combined per task before the shuffle.
    """
    ids = _ids(cardio_samples)
    bpm = F.col("heart_rate_bpm")
    return (
        cardio_samples.filter(bpm.isNotNull() & F.col("elapsed_seconds").isNotNull())
        .groupBy(*ids, F.floor(F.col("elapsed_seconds") / 60).alias("minute"))
        .agg(
            F.count(bpm).alias("num_samples"),
            F.sum(paths.round_to_long(bpm * 1_000_000)).alias("_sum"),
            F.max(bpm).alias("max_heart_rate"),
        )
        .select(
            *ids,
            "minute",
            "num_samples",
            (F.col("_sum") / 1_000_000 / F.col("num_samples")).alias("avg_heart_rate"),
            "max_heart_rate",
        )
    )
