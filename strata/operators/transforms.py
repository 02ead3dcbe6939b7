"""Dataset-specific standardisation: bronze preparation and silver projections."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.names import rename_existing
from strata.functions.temporal import date_and_time, timestamp_from_parts, utc_to_local

# The weather station, the speed conversion and the source-to-silver column names.
STATION_ID = "72505394728"
KMH_PER_MS = 3.6
ZONE_NAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
AIR_NAMES = {
    "County_Code": "county_code",
    "Site_Num": "site_num",
    "Parameter_Name": "parameter",
    "Date_GMT": "date_gmt",
    "Time_GMT": "time_gmt",
    "Sample_Measurement": "value",
    "Units_of_Measure": "unit",
}
TRIP_NAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}
TRIP_TIME_NAMES = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"}


# --- bronze preparation -------------------------------------------------------------------------------------


def prepare_weather(df: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    """Add the observation date; an impossible day becomes null instead of failing the load."""
    return df.withColumn("observation_date", F.to_date(timestamp_from_parts("year", "month", "day", F.lit(0))))


def prepare_air_quality(df: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    """State code under its stored name, and the measurement date."""
    return df.withColumnRenamed("State Code", "state_code").withColumn(
        "measurement_date", F.to_date(F.try_to_timestamp(F.col("Date GMT").cast("string"), F.lit("yyyy-MM-dd")))
    )


def prepare_trips(df: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    """Neutral time names, the fleet label and the pickup date."""
    return rename_existing(df, TRIP_TIME_NAMES).withColumns(
        {"taxi_type": F.lit(options.get("taxi_type", "yellow")), "pickup_date": F.to_date("pickup_datetime")}
    )


PREPARATIONS: dict[str, Callable[[DataFrame, Mapping[str, Any]], DataFrame]] = {
    "observation_date_from_ymd": prepare_weather,
    "air_quality_bronze": prepare_air_quality,
    "normalize_yellow_trips": prepare_trips,
}


def prepare(df: DataFrame, name: str | None, options: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a named preparation; an unnamed or unknown one leaves the frame unchanged."""
    step = PREPARATIONS.get(name or "")
    return step(df, options or {}) if step else df


# --- silver projections -------------------------------------------------------------------------------------


def _number(name: str, kind: str = "double", source: str | None = None):
    return F.col(source or name).try_cast(kind).alias(name)


def _evolved(df: DataFrame, name: str) -> list:
    """The column as a double if an update has brought it, else nothing."""
    return [_number(name)] if name in df.columns else []


def zones_to_silver(df: DataFrame) -> DataFrame:
    out = rename_existing(df, ZONE_NAMES).select(
        _number("location_id", "int"), *[F.col(c).cast("string").alias(c) for c in ("borough", "zone", "service_zone")]
    )
    return out.fillna("UNKNOWN", subset=["borough", "zone", "service_zone"])


def weather_to_silver(df: DataFrame) -> DataFrame:
    timed = df.withColumn("obs_timestamp", timestamp_from_parts("year", "month", "day", "hour"))
    return timed.select(
        F.lit(STATION_ID).alias("station_id"),
        "obs_timestamp",
        _number("temperature_c", source="temp"),
        (F.col("wspd").try_cast("double") / F.lit(KMH_PER_MS)).alias("wind_speed_ms"),
        F.to_date("obs_timestamp").alias("observation_date"),
        F.hour("obs_timestamp").alias("observation_hour"),
        *_evolved(df, "humidity"),
    )


def air_quality_to_silver(df: DataFrame) -> DataFrame:
    named = rename_existing(df, AIR_NAMES)
    timed = named.withColumn("measurement_timestamp", utc_to_local(date_and_time("date_gmt", "time_gmt")))
    return timed.select(
        *[_number(c, "int") for c in ("state_code", "county_code", "site_num")],
        F.col("parameter").cast("string").alias("parameter"),
        _number("value"),
        F.col("unit").cast("string").alias("unit"),
        "measurement_timestamp",
        F.to_date("measurement_timestamp").alias("measurement_date"),
        F.hour("measurement_timestamp").alias("measurement_hour"),
        *_evolved(df, "aqi"),
    )


def trips_to_silver(df: DataFrame) -> DataFrame:
    named = rename_existing(df, TRIP_NAMES)
    timed = named.withColumns({c: F.col(c).try_cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")})
    return timed.select(
        F.col("taxi_type").cast("string").alias("taxi_type"),
        _number("vendor_id", "int"),
        "pickup_datetime",
        "dropoff_datetime",
        _number("passenger_count", "int"),
        _number("trip_distance"),
        _number("pickup_location_id", "int"),
        _number("dropoff_location_id", "int"),
        *[_number(c) for c in ("fare_amount", "tip_amount", "tolls_amount", "total_amount")],
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.hour("pickup_datetime").alias("pickup_hour"),
    )


TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "taxi_zones": zones_to_silver,
    "weather": weather_to_silver,
    "air_quality": air_quality_to_silver,
    "taxi_trips": trips_to_silver,
}


def to_silver(df: DataFrame, name: str) -> DataFrame:
    if name not in TRANSFORMS:
        raise KeyError(f"{name} has no standardising step; known are: {", ".join(TRANSFORMS)}")
    return TRANSFORMS[name](df)
