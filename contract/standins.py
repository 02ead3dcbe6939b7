"""Driver tables in the shape of the trip domain, in Spark and as SQL.

Purchases and clicks stand for trips, customers for zones (their nation is the zone name, their region the
borough), error and view events for weather readings and sign-ups for air-quality readings.  Customers with a
negative balance are left out of the zone list so that lookups miss.  Each frame has the raw column names and goes
through the library's own preparation and silver projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.numeric import pm25_to_aqi
from strata.operators.enrich import add_zone, build_integrated
from strata.operators.transforms import prepare, to_silver


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table.  Its schema is inferred once per path, which saves a footer job on every later read."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def events(spark: SparkSession, sf: str, *types: str) -> DataFrame:
    df = table(spark, sf, "events")
    return df.filter(F.col("event_type").isin(*types)) if types else df


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    return events(spark, sf, "purchase", "click").select(
        F.when(F.col("event_type") == "click", 1).otherwise(2).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", F.floor(value * 10).cast("int"), F.col("ts")).alias("tpep_dropoff_datetime"),
        (F.hour("ts") % 4 + 1).cast("bigint").alias("passenger_count"),
        value.alias("trip_distance"),
        F.col("user_id").alias("PULocationID"),
        F.floor(value).alias("DOLocationID"),
        value.alias("fare_amount"),
        F.floor(value / 10).cast("double").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        (value + F.floor(value / 10)).alias("total_amount"),
    )


def raw_zones(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (
        customer.filter(F.col("c_acctbal") >= 0)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.col("c_mktsegment").alias("service_zone"),
        )
    )


def raw_weather(spark: SparkSession, sf: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_type")
    return events(spark, sf, "error", "view").select(
        F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"),
        F.when(kind == "error", value / 4 - 10).alias("temp"),
        F.when(kind == "view", value * 0.18).alias("wspd"),
        F.when(kind == "view", value / 5).alias("humidity"),
    )


def raw_air_quality(spark: SparkSession, sf: str) -> DataFrame:
    counties = F.array(*[F.lit(c) for c in (5, 47, 61, 81, 85, 1, 3)])
    return events(spark, sf, "signup").select(
        F.lit(36).alias("State Code"),
        F.element_at(counties, (F.col("user_id") % 7 + 1).cast("int")).alias("County Code"),
        F.col("user_id").cast("int").alias("Site Num"),
        F.lit("PM2.5").alias("Parameter Name"),
        F.date_format("ts", "yyyy-MM-dd").alias("Date GMT"),
        F.date_format("ts", "HH:mm").alias("Time GMT"),
        (F.col("value") / 10).alias("Sample Measurement"),
        F.lit("ug/m3").alias("Units of Measure"),
        pm25_to_aqi(F.col("value") / 10).alias("aqi"),
    )


def silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(prepare(raw_trips(spark, sf), "normalize_yellow_trips"), "taxi_trips")


def silver_zones(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(raw_zones(spark, sf), "taxi_zones")


def silver_weather(spark: SparkSession, sf: str, humidity: bool = True) -> DataFrame:
    raw = raw_weather(spark, sf)
    return to_silver(raw if humidity else raw.drop("humidity"), "weather")


def silver_air_quality(spark: SparkSession, sf: str, aqi: bool = True) -> DataFrame:
    raw = raw_air_quality(spark, sf)
    bronze = prepare(raw if aqi else raw.drop("aqi"), "air_quality_bronze")
    return to_silver(bronze.toDF(*[c.replace(" ", "_") for c in bronze.columns]), "air_quality")


def integrated(spark: SparkSession, sf: str, evolved: bool = True, keep_extra: bool = False) -> DataFrame:
    return build_integrated(
        silver_trips(spark, sf), silver_weather(spark, sf, evolved), silver_air_quality(spark, sf, evolved),
        silver_zones(spark, sf), keep_extra=keep_extra,
    )


def order_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as trips over several years, with the zone of their customer."""
    zones = silver_zones(spark, sf)
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("int").alias("pickup_location_id"),
        F.to_date("o_orderdate").alias("pickup_date"),
        F.hour("o_orderdate").alias("pickup_hour"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").alias("total_amount"),
    )
    return add_zone(orders, zones, "pickup")


# The same shapes in SQL.  All readings fall in January, so New York is five hours behind throughout.
AQI_SQL = """CASE WHEN value / 10 <= 9.0 THEN (CAST(50 AS DOUBLE) / 9.0) * (value / 10)
    WHEN value / 10 <= 35.4 THEN (CAST(49 AS DOUBLE) / (CAST(35.4 AS DOUBLE) - 9.1)) * (value / 10 - 9.1) + 51
    WHEN value / 10 <= 55.4 THEN (CAST(49 AS DOUBLE) / (CAST(55.4 AS DOUBLE) - 35.5)) * (value / 10 - 35.5) + 101
    WHEN value / 10 <= 125.4 THEN (CAST(49 AS DOUBLE) / (CAST(125.4 AS DOUBLE) - 55.5)) * (value / 10 - 55.5) + 151
    WHEN value / 10 <= 225.4 THEN (CAST(99 AS DOUBLE) / (CAST(225.4 AS DOUBLE) - 125.5)) * (value / 10 - 125.5) + 201
    ELSE 500 END"""

STANDIN_CTES = f"""
trips AS (
  SELECT event_type AS fleet, 'yellow' AS taxi_type,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS INTEGER) AS vendor_id,
         ts AS pickup_datetime, ts + to_seconds(CAST(floor(value * 10) AS BIGINT)) AS dropoff_datetime,
         CAST(hour(ts) % 4 + 1 AS INTEGER) AS passenger_count, value AS trip_distance,
         CAST(user_id AS INTEGER) AS pickup_location_id, CAST(floor(value) AS INTEGER) AS dropoff_location_id,
         value AS fare_amount, floor(value / 10) AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
         value + floor(value / 10) AS total_amount,
         CAST(ts AS DATE) AS pickup_date, CAST(hour(ts) AS INTEGER) AS pickup_hour
  FROM events WHERE event_type IN ('purchase', 'click')),
zones AS (
  SELECT CAST(c_custkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone, c_mktsegment AS service_zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal >= 0),
weather AS (
  SELECT '72505394728' AS station_id, date_trunc('hour', ts) AS obs_timestamp,
         CASE WHEN event_type = 'error' THEN value / 4 - 10 END AS temperature_c,
         CASE WHEN event_type = 'view' THEN value * 0.18 END / 3.6 AS wind_speed_ms,
         CAST(ts AS DATE) AS observation_date, CAST(hour(ts) AS INTEGER) AS observation_hour,
         CASE WHEN event_type = 'view' THEN value / 5 END AS humidity
  FROM events WHERE event_type IN ('error', 'view')),
air_quality AS (
  SELECT 36 AS state_code, [5, 47, 61, 81, 85, 1, 3][user_id % 7 + 1] AS county_code,
         CAST(user_id AS INTEGER) AS site_num, 'PM2.5' AS parameter, value / 10 AS value, 'ug/m3' AS unit,
         date_trunc('minute', ts) - INTERVAL 5 HOUR AS measurement_timestamp,
         CAST(ts - INTERVAL 5 HOUR AS DATE) AS measurement_date,
         CAST(hour(ts - INTERVAL 5 HOUR) AS INTEGER) AS measurement_hour,
         CAST(least(500, round_even({AQI_SQL}, 0)) AS DOUBLE) AS aqi
  FROM events WHERE event_type = 'signup'),
hourly_weather AS (
  SELECT observation_date AS pickup_date, observation_hour AS pickup_hour, AVG(temperature_c) AS temperature_c,
         AVG(wind_speed_ms) AS wind_speed_ms, AVG(humidity) AS humidity FROM weather GROUP BY 1, 2),
hourly_air AS (
  SELECT measurement_date AS pickup_date, measurement_hour AS pickup_hour, AVG(value) AS pm25,
         MIN(unit) AS pm25_unit, AVG(aqi) AS aqi
  FROM air_quality WHERE county_code IN (5, 47, 61, 81, 85) GROUP BY 1, 2),
integrated AS (
  SELECT t.*, COALESCE(p.zone, 'UNKNOWN') AS pickup_zone, COALESCE(p.borough, 'UNKNOWN') AS pickup_borough,
         COALESCE(d.zone, 'UNKNOWN') AS dropoff_zone, COALESCE(d.borough, 'UNKNOWN') AS dropoff_borough,
         w.temperature_c, w.wind_speed_ms, w.humidity, a.pm25, a.pm25_unit, a.aqi
  FROM trips t
  LEFT JOIN zones p ON t.pickup_location_id = p.location_id
  LEFT JOIN zones d ON t.dropoff_location_id = d.location_id
  LEFT JOIN hourly_weather w ON t.pickup_date = w.pickup_date AND t.pickup_hour = w.pickup_hour
  LEFT JOIN hourly_air a ON t.pickup_date = a.pickup_date AND t.pickup_hour = a.pickup_hour),
order_trips AS (
  SELECT CAST(o_custkey AS INTEGER) AS pickup_location_id, CAST(o_orderdate AS DATE) AS pickup_date,
         CAST(hour(o_orderdate) AS INTEGER) AS pickup_hour, o_totalprice AS fare_amount,
         COALESCE(zone, 'UNKNOWN') AS pickup_zone, COALESCE(borough, 'UNKNOWN') AS pickup_borough
  FROM orders LEFT JOIN zones ON o_custkey = location_id)
"""


def with_standins(select: str, *more: str) -> str:
    """A query over the stand-in shapes; ``more`` are further common table expressions."""
    return "WITH " + ",\n".join([STANDIN_CTES.strip(), *more]) + "\n" + select


def rounded(expression: str, digits: int = 2) -> str:
    """Half-up rounding in decimal arithmetic, after the noise of summed doubles has been cut off."""
    return f"CAST(ROUND(CAST(ROUND({expression}, 8) AS DECIMAL(28, 8)), {digits}) AS DOUBLE)"


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as plain wall-clock values, which compare without a time zone."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
