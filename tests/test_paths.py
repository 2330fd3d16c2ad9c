from __future__ import annotations

import datetime as dt
import hashlib

from helpers import column, rows, variants
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.functions.keys import surrogate_key

V = "v"


def values(spark, expr, *texts):
    got = {r["n"]: r["x"] for r in variants(spark, *texts).select("n", expr.alias("x")).collect()}
    return [got[i] for i in range(len(texts))]


def test_integers_round_half_away_from_zero(spark):
    got = values(spark, paths.as_int(V, "$.x"), '{"x":71.5}', '{"x":-71.5}', '{"x":"12.6"}', '{"x":3}', '{"x":2.4}')
    assert got == [72, -72, 13, 3, 2]


def test_missing_and_null_are_null(spark):
    texts = ['{"y":1}', '{"x":null}', "null", "[]"]
    assert values(spark, paths.as_int(V, "$.x"), *texts) == [None] * 4
    assert values(spark, paths.as_string(V, "$.x.y.z"), *texts) == [None] * 4


def test_booleans_accept_text(spark):
    assert values(spark, paths.as_boolean(V, "$.x"), '{"x":true}', '{"x":"true"}', '{"x":"false"}') == [True, True, False]


def test_first_element_of_an_empty_list_is_null(spark):
    assert values(spark, paths.as_int(V, "$[0].a"), "[]", '[{"a":7},{"a":8}]') == [None, 7]


def test_array_size(spark):
    assert values(spark, paths.array_size(V), "[1,[2,3]]", "[]", "{}", "3", "null") == [2, 0, None, None, None]


def test_local_text_is_read_in_the_given_zone(spark):
    utc = paths.instant_to_utc_ntz(paths.as_local_timestamp(V, "$.t", "America/Los_Angeles"))
    got = values(spark, utc, '{"t":"2024-08-09 06:12:33"}', '{"t":"2024-01-09T06:12:33.5"}')
    assert got == [dt.datetime(2024, 8, 9, 13, 12, 33), dt.datetime(2024, 1, 9, 14, 12, 33, 500000)]


def test_epoch_ms_stays_wall_clock_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            local = paths.epoch_ms_to_ntz(V, "$.t")
            back = paths.ntz_to_ms(local)
            assert values(spark, local, '{"t":1720505553250}') == [dt.datetime(2024, 7, 9, 6, 12, 33, 250000)]
            assert values(spark, back, '{"t":1720505553250}') == [1720505553250]
            instant = paths.instant_to_utc_ntz(paths.ms_to_instant(F.lit(1720505553250.0)))
            assert values(spark, instant, "1") == [dt.datetime(2024, 7, 9, 6, 12, 33, 250000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_instants_become_utc(spark):
    df = spark.createDataFrame([("2024-02-01T02:00:00-08:00",), ("2024-02-01T02:00:00.5Z",)], "t string")
    got = rows(df.select(paths.iso_instant_to_utc_ntz(F.col("t"))))
    want = [(dt.datetime(2024, 2, 1, 10, 0),), (dt.datetime(2024, 2, 1, 2, 0, 0, 500000),)]
    assert got == sorted(want, key=repr)


def test_truthiness_of_payload_text(spark):
    falsy = [None, "", " ", "null", "{}", "{ }", "[]", "[ \n]", '""', "0", "0.0", "-0", "0e5", "false"]
    truthy = ['{"a":0}', "[0]", '"0"', "1", "0.1", "true", "[[]]"]
    df = spark.createDataFrame([(x,) for x in falsy + truthy], "p string")
    kept = column(df.filter(paths.is_truthy_json(F.col("p"))), "p")
    assert kept == sorted(truthy, key=repr)


def test_truthy_text_depends_on_type(spark):
    texts = ['{"d":"2024-01-01"}', '{"d":""}', '{"d":"0"}', '{"d":0}', '{"d":20240101}', '{"d":true}', '{"d":false}']
    texts += ['{"d":null}', '{"d":[]}', '{"d":{}}', '[{"d":"x"}]', "5"]
    got = values(spark, paths.truthy_text(V, "$.d"), *texts)
    assert got == ["2024-01-01", None, "0", None, "20240101", "True", None, None, None, None, None, None]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = column(df.select(surrogate_key("x", "y").alias("k")), "k")
    assert len(set(keys)) == 3
    assert hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest() in keys
    assert hashlib.md5(b"a-b").hexdigest() in keys


def test_doubles_round_half_away_from_zero(spark):
    given = [0.4, 0.5, 1.5, 2.5, -0.5, -1.5, -2.4, 1720505553250.5, 0.0, None]
    df = spark.createDataFrame(list(enumerate(given)), "n int, x double")
    got = [r[0] for r in df.orderBy("n").select(paths.round_to_long(F.col("x"))).collect()]
    assert got == [0, 1, 2, 3, -1, -2, -2, 1720505553251, 0, None]
