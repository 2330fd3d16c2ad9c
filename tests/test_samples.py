from __future__ import annotations

import pytest
from helpers import column, detail_envelope, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.operators import samples
from pulseframe.plans import staging


def d(i, key, unit="u"):
    out = {"key": key, "unit": {"key": unit}}
    return out if i is None else {"metricsIndex": i, **out}


def s(*values):
    return {"metrics": list(values)}


PAYLOADS = {
    # two layouts of the same keys
    "run": {
        "metricDescriptors": [d(0, "directTimestamp"), d(1, "directLatitude"), d(2, "directHeartRate")],
        "activityDetailMetrics": [s(1000.4, 45.5, 120), s(2000, None, 121)],
    },
    "lift": {
        "metricDescriptors": [d(1, "directTimestamp"), d(0, "directHeartRate")],
        "activityDetailMetrics": [s(90, 5000)],
    },
    # declared twice, past the end, negative and missing position, missing key
    "odd": {
        "metricDescriptors": [
            d(0, "directHeartRate"),
            d(1, "directHeartRate"),
            d(9, "sumDistance"),
            d(-1, "directBodyBattery"),
            d(None, "sumMovingDuration"),
            {"metricsIndex": 0},
        ],
        "activityDetailMetrics": [s(3, 5), s(7, None), {}],
    },
    "no descriptors": {"metricDescriptors": [], "activityDetailMetrics": [s(1)]},
    "descriptors missing": {"activityDetailMetrics": [s(1)]},
    "no samples": {"metricDescriptors": [d(0, "directLatitude")], "activityDetailMetrics": []},
    "samples missing": {"metricDescriptors": [d(0, "directLatitude")]},
    "other metrics": {"metricDescriptors": [d(0, "directPower")], "activityDetailMetrics": [s(200), s(210)]},
    "null latitude": {"metricDescriptors": [d(0, "directLatitude")], "activityDetailMetrics": [s(None), {"metrics": None}]},
    "nothing": {"metricDescriptors": None, "activityDetailMetrics": None},
}


@pytest.fixture(scope="module")
def series(spark):
    return samples.series_from_envelope(detail_envelope(spark, PAYLOADS))


def test_long_form(series):
    long = samples.unpivot(series)
    counts = {r[0]: r[1] for r in long.groupBy("activity_id").count().collect()}
    assert counts == {"run": 6, "lift": 2, "odd": 18, "other metrics": 2, "null latitude": 2}
    got = {(r.activity_id, r.sample_index, r.metric_key): r.metric_value for r in long.filter("activity_id != 'odd'").collect()}
    assert got[("run", 0, "directLatitude")] == 45.5
    assert got[("run", 1, "directLatitude")] is None
    assert got[("lift", 0, "directHeartRate")] == 90.0
    odd = rows(long.filter("activity_id = 'odd' and metric_key != 'directHeartRate'").select("metric_value"))
    assert set(odd) == {(None,)}


def test_cardio_reads_each_layout_and_the_larger_of_two_declarations(series):
    cardio = samples.cardio(series)
    got = {(r.activity_id, r.sample_index): r.heart_rate_bpm for r in cardio.collect()}
    assert got == {
        ("run", 0): 120.0,
        ("run", 1): 121.0,
        ("lift", 0): 90.0,
        ("odd", 0): 5.0,
        ("odd", 1): 7.0,
        ("odd", 2): None,
        ("other metrics", 0): None,
        ("other metrics", 1): None,
        ("null latitude", 0): None,
        ("null latitude", 1): None,
    }
    moments = cardio.filter("activity_id = 'run'").select(F.unix_millis("recorded_at"))
    assert rows(moments) == [(1000,), (2000,)]


def test_gps_scope_is_by_declaration(series):
    assert column(samples.gps(series), "activity_id") == ["null latitude", "null latitude", "run", "run"]
    assert column(samples.gps_capable(series), "activity_id") == ["null latitude", "run"]


def test_row_local_and_long_forms_agree(series):
    long = samples.unpivot(series)
    joined = samples.unpivot_join(samples.explode_descriptors(series), samples.explode_samples(series), salts=3)
    assert rows(joined) == rows(long)
    assert rows(samples.cardio_long(long)) == rows(samples.cardio(series))
    assert rows(samples.gps_long(long, salts=3)) == rows(samples.gps(series))
    assert rows(samples.gps_capable_long(long)) == rows(samples.gps_capable(series))


def test_staging_columns_give_the_same_series(spark):
    env = detail_envelope(spark, PAYLOADS).selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:00' as extracted_at", "'m' as source_method"
    )
    staged = staging.stage(env, "activity_details")
    assert rows(samples.cardio(samples.series_from_staging(staged))) == rows(
        samples.cardio(samples.series_from_envelope(env))
    )


def test_subjects_keep_their_activities_apart(spark):
    one = detail_envelope(spark, {"a": PAYLOADS["run"]})
    env = one.withColumn("subject_id", F.lit(1)).unionByName(one.withColumn("subject_id", F.lit(2)))
    cardio = samples.cardio(samples.series_from_envelope(env))
    assert cardio.count() == 4 and cardio.select("sk").distinct().count() == 4


def test_malformed_values_raise_or_are_singled_out(spark):
    bad = {
        "good": PAYLOADS["run"],
        "bad value": {"metricDescriptors": [d(0, "x")], "activityDetailMetrics": [s("twelve")]},
        "object": {"metricDescriptors": {"a": 1}, "activityDetailMetrics": [s(1)]},
        "absent": {},
    }
    env = detail_envelope(spark, bad)
    assert column(samples.malformed(env), "natural_key") == ["bad value", "object"]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        samples.unpivot(samples.series_from_envelope(env)).collect()
    lenient = samples.unpivot(samples.series_from_envelope(env, strict=False))
    assert rows(lenient.filter("activity_id != 'good'").select("activity_id", "metric_value")) == [("bad value", None)]


KEYS = ["directTimestamp", "directHeartRate", "directLatitude", "sumDistance", "directPower"]
ACTIVITY = st.fixed_dictionaries(
    {
        "metricDescriptors": st.lists(
            st.builds(d, st.integers(0, 4), st.sampled_from(KEYS)), max_size=5
        ),
        "activityDetailMetrics": st.lists(
            st.lists(st.one_of(st.none(), st.integers(-50, 50), st.floats(-1, 1).map(lambda x: round(x, 3) + 0.0)), max_size=4).map(
                lambda v: s(*v)
            ),
            max_size=4,
        ),
    }
)


def brute_long(payloads):
    out = []
    for aid, p in payloads.items():
        for i, smp in enumerate(p["activityDetailMetrics"]):
            for desc in p["metricDescriptors"]:
                m, at = smp["metrics"], desc["metricsIndex"]
                value = float(m[at]) if at < len(m) and m[at] is not None else None
                out.append((aid, i, desc["key"], value))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ACTIVITY, min_size=1, max_size=6))
def test_against_brute_force(spark, activities):
    payloads = {f"a{i}": a for i, a in enumerate(activities)}
    series = samples.series_from_envelope(detail_envelope(spark, payloads))
    want = brute_long(payloads)
    long = samples.unpivot(series).select("activity_id", "sample_index", "metric_key", "metric_value")
    assert rows(long) == sorted(want, key=repr)
    hr = {}
    for aid, i, key, value in want:
        best = hr.setdefault((aid, i), None)
        if key == "directHeartRate" and value is not None:
            hr[(aid, i)] = value if best is None else max(best, value)
    got = {(r.activity_id, r.sample_index): r.heart_rate_bpm for r in samples.cardio(series).collect()}
    assert got == hr


def test_heart_rate_by_minute(spark):
    data = [("a", 0.0, 100.0), ("a", 59.9, 110.0), ("a", 60.0, 120.5), ("a", 61.0, None), ("b", None, 90.0)]
    cardio = spark.createDataFrame(data, "activity_id string, elapsed_seconds double, heart_rate_bpm double")
    assert rows(samples.heart_rate_by_minute(cardio)) == [("a", 0, 2, 105.0, 110.0), ("a", 1, 1, 120.5, 120.5)]


def test_plans_over_stored_payloads(spark, tmp_path):
    path = str(tmp_path / "details")
    detail_envelope(spark, PAYLOADS).write.parquet(path)
    series = samples.series_from_envelope(spark.read.parquet(path))
    for df in (samples.unpivot(series), samples.cardio(series), samples.gps(series)):
        text = plan(df)
        assert "Exchange" not in text and "Join" not in text
        assert "variant_get" not in text, "payload paths should be read by the scan"
    assert plan(samples.heart_rate_by_minute(samples.cardio(series))).count("Exchange") == 1
