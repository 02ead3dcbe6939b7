"""Column helpers against literal cases."""

from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.functions.names import rename_existing, resolve_alias, safe_name, with_alias, with_safe_columns
from strata.functions.numeric import clamp, pm25_to_aqi, stable_round
from strata.functions.temporal import date_and_time, first_timestamp, timestamp_from_parts, utc_to_local
from strata.functions.types import align_to, cast_declared, schema_errors
from strata.functions.weather import temperature_bin, wind_bin, wind_chill_index


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_safe_names(spark):
    assert safe_name(" a b,c;d{e}f(g)h\ti=j\nk ") == "a_b_c_d_e_f_g_h_i_j_k"
    assert with_safe_columns(spark.range(1).toDF("State Code")).columns == ["State_Code"]
    with pytest.raises(ValueError, match="collide"):
        with_safe_columns(spark.range(1).selectExpr("id AS `a b`", "id AS a_b"))


def test_aliases(spark):
    df = spark.range(1).toDF("WSPD")
    assert rename_existing(df, {"WSPD": "w", "none": "x"}).columns == ["w"]
    assert with_alias(df, "wind", ("wind", "wspd")).columns == ["wind"]
    with pytest.raises(ValueError, match="can serve as"):
        resolve_alias(df.columns, ("temp",), "temperature_c")


@pytest.mark.parametrize("value, label", [
    (-0.01, "Freezing"), (0.0, "Cold"), (10.0, "Cold"), (10.005, "Warm"), (10.01, "Moderate"), (20.0, "Moderate"),
    (20.01, "Warm"), (None, "Unknown"),
])
def test_temperature_bins(spark, value, label):
    df = spark.createDataFrame([(value,)], "t double")
    assert values(df, temperature_bin("t"))[0].startswith(label)


@pytest.mark.parametrize("value, label", [
    (1.99, "Calm"), (2.0, "Moderate"), (6.0, "Moderate"), (6.01, "High"), (None, "Unknown"),
])
def test_wind_bins(spark, value, label):
    df = spark.createDataFrame([(value,)], "w double")
    assert values(df, wind_bin("w"))[0].startswith(label)


def test_wind_chill_rises_with_cold(spark):
    df = spark.createDataFrame([(4.0, 20.0), (4.0, -5.0), (None, 1.0)], "w double, t double")
    mild, cold, missing = values(df, wind_chill_index("w", "t"))
    assert math.isclose(mild, (20 - 4 + 10.5) * 13) and cold > mild and missing is None


@pytest.mark.parametrize("reading, index", [
    ("-1", "0"), ("0", "0"), ("9.0", "50"), ("9.05", "51"), ("35.4", "100"), ("500.4", "500"), ("501", "500"),
    ("", ""), (None, ""), ("bad", ""), ("NaN", "0"), ("12.0", "56"), ("55.4", "150"),
])
def test_aqi(spark, reading, index):
    df = spark.createDataFrame([(reading,)], "r string")
    assert values(df, pm25_to_aqi("r")) == [index]


def test_rounding_ignores_summation_noise(spark):
    df = spark.createDataFrame([(5.024999999999999,), (5.025,), (5.0250000000000004,), (None,)], "v double")
    assert values(df, stable_round("v", 2)) == [5.03, 5.03, 5.03, None]


def test_clamp(spark):
    df = spark.createDataFrame([(-5.0,), (5.0,), (50.0,), (None,)], "v double")
    assert values(df, clamp("v", 0.0, 10.0)) == [0.0, 5.0, 10.0, None]


def test_time_parsing(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("01/02/2024 03:04:05",), ("nonsense",), (None,)], "s string")
    expected = datetime(2024, 1, 2, 3, 4, 5)
    assert values(df, first_timestamp("s").cast("timestamp_ntz")) == [expected, expected, None, None]


def test_parts_and_clock(spark):
    df = spark.createDataFrame([(2024, 2, 29, "5"), (2024, 2, 30, "5"), (2024, 2, 1, "5.0"), (2024, 2, 1, "x")],
                               "y int, m int, d int, h string")
    got = values(df, timestamp_from_parts("y", "m", "d", "h").cast("timestamp_ntz"))
    assert got == [datetime(2024, 2, 29, 5), None, datetime(2024, 2, 1, 5), None]
    clock = spark.createDataFrame([("2024-01-01", "05:30"), ("2024-01-01", "05:30:10"), (None, "05:30"), ("2024-01-01", None)],
                                  "d string, t string")
    got = values(clock, date_and_time("d", "t").cast("timestamp_ntz"))
    assert got == [datetime(2024, 1, 1, 5, 30), datetime(2024, 1, 1, 5, 30, 10), None, None]


def test_fall_back_hour_folds_two_instants_into_one(spark):
    df = spark.createDataFrame([("2024-11-03 05:30:00",), ("2024-11-03 06:30:00",)], "s string")
    local = values(df, utc_to_local(F.col("s").cast("timestamp")).cast("timestamp_ntz"))
    assert local == [datetime(2024, 11, 3, 1, 30)] * 2


def test_declared_casts(spark):
    df = spark.createDataFrame([("5", "5.7", "N/A", "2024-01-01", "keep")], "a string, b string, c string, d string, e string")
    out = cast_declared(df, {"a": "integer", "b": "long", "c": "double", "d": "date", "e": "mystery", "z": "double"})
    assert out.dtypes == [("a", "int"), ("b", "bigint"), ("c", "double"), ("d", "date"), ("e", "string")]
    assert out.first() == (5, 5, None, date(2024, 1, 1), "keep")


def test_schema_errors_and_alignment(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert schema_errors(df.schema, {"a": "long", "b": "string"}) == []
    assert schema_errors(df.schema, {"b": "integer", "c": "double"}) == [
        "b: got string, expected integer", "missing column: c"]
    target = spark.createDataFrame([(1.0,)], "a double").schema
    assert align_to(df, target).dtypes == [("a", "double"), ("b", "string")]
