"""Scalar expressions against hand-made edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from healthmart.functions import encode as E
from healthmart.functions import features as X
from healthmart.operators import star as st


def col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_binary_and_gender_text_forms(spark):
    vals = [(" yes ",), ("YES",), ("no",), ("maybe",), (None,), ("\tYes\n",)]
    assert col(spark, vals, "x string", E.encode_binary("x")) == [1, 1, 0, 0, 0, 1]
    g = [("f",), (" M ",), ("X",), (None,), ("F",)]
    assert col(spark, g, "x string", E.encode_gender("x", male="M", female="F", case="upper")) == [1, 0, -1, -1, 1]
    d = [("Female",), ("male ",), ("Other",)]
    assert col(spark, d, "x string", E.encode_gender("x", male="male", female="female")) == [1, 0, -1]


def test_ordinal_unknown_is_normal(spark):
    vals = [("Low",), ("normal",), (" HIGH",), ("odd",), (None,)]
    assert col(spark, vals, "x string", E.encode_ordinal("x")) == [0, 1, 2, 1, 1]


def test_sql_trim_keeps_tabs(spark):
    # the SQL form trims spaces only, so a tab-padded value does not match
    assert col(spark, [("yes\t",)], "x string", E.encode_binary("x", whitespace=False)) == [0]


def test_rounding_modes(spark):
    rows = [(2.25,), (0.125,)]
    assert col(spark, rows, "x double", E.round_half_up("x", 1)) == [2.3, 0.1]
    assert col(spark, rows, "x double", E.round_half_even("x", 1)) == [2.2, 0.1]
    assert col(spark, rows, "x double", E.round_half_up("x", 2)) == [2.25, 0.13]
    assert col(spark, rows, "x double", E.round_half_even("x", 2)) == [2.25, 0.12]


def test_same_day_wait_is_fractional(spark):
    df = spark.createDataFrame([("2016-04-29T18:38:08Z", "2016-04-29T00:00:00Z")], "s string, a string")
    df = df.select(X.parse_timestamp(df, "s").alias("s"), X.parse_timestamp(df, "a").alias("a"))
    exact, rounded = df.select(X.wait_days("s", "a", None), X.wait_days("s", "a", 1)).first()
    assert math.isclose(exact, 0.7764814814814814, rel_tol=1e-12)
    assert rounded == 0.8


def test_parse_garbage_and_blank_to_null(spark):
    df = spark.createDataFrame([("garbage",), (None,), ("Unknown",), ("2016-05-01 10:00:00",)], "t string")
    out = [r[0] for r in df.select(X.parse_timestamp(df, "t")).collect()]
    assert out[:3] == [None, None, None] and out[3] is not None


def test_weekday_bases_and_weekend(spark):
    df = spark.createDataFrame([("2016-04-30",), ("2016-05-01",), ("2016-05-02",)], "d string") \
        .select(F.to_timestamp("d").alias("d"))
    rows = df.select(X.day_of_week("d", "sunday"), X.day_of_week("d", "monday"),
                     X.weekend_flag(X.day_of_week("d", "sunday"))).collect()
    assert [tuple(r) for r in rows] == [(6, 5, 1), (0, 6, 1), (1, 0, 0)]
    assert col(spark, [(None,)], "d timestamp", X.weekend_flag(X.day_of_week("d"))) == [0]


@pytest.mark.parametrize("default", [3, 5])
def test_age_group_bounds(spark, default):
    ages = [12.0, 13.0, 17.0, 18.0, 35.0, 36.0, 59.0, 60.0, None, 12.5, 121.0]
    got = col(spark, [(a,) for a in ages], "a double", st.age_group_id(F.col("a"), default, null_value=default))
    assert got == [1, 2, 2, 3, 3, 4, 4, 5, default, default, default]


def test_wait_bucket_bounds(spark):
    waits = [0.0, 7.0, 7.1, 30.0, 60.0, 60.1]
    got = col(spark, [(w,) for w in waits], "w double", X.wait_bucket("w"))
    assert got == ["0 hari (sama hari)", "1-7 hari", "8-30 hari", "8-30 hari", "31-60 hari", "> 60 hari"]


def test_row_sum_coerces_junk(spark):
    df = spark.createDataFrame([("3", "abc", None)], "handcap string, diabetes string, alcoholism string")
    assert df.select(X.row_sum(["handcap", "diabetes", "alcoholism"])).first()[0] == 3


def test_decode_labels(spark):
    rows = [(0,), (6,), (None,)]
    assert col(spark, rows, "d int", X.weekday_name("d")) == ["Minggu", "Sabtu", "Unknown"]
    assert col(spark, [(0,), (1,), (-1,)], "g int", X.gender_name("g")) == ["Laki-laki", "Perempuan", "Lainnya"]
