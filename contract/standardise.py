"""Typed scans, preparation, silver projections, unions and parsing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from contract.standins import rounded, with_standins
from strata.functions.names import rename_existing
from strata.functions.numeric import pm25_to_aqi, stable_round
from strata.functions.temporal import first_timestamp, shift_seconds, utc_to_local
from strata.functions.types import cast_declared
from strata.operators.transforms import prepare
from strata.plans import raw_training
from strata.plans.evaluation import broadcast_join, hour_context_join, merge_join, on_day
from strata.plans.updates import recent_window
from strata.sources.files import apply_filter, union_update


# --- scans ----------------------------------------------------------------------------------------------------


@query("typed_projection", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, TRY_CAST(p_name AS INTEGER) AS p_name,
       CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(CAST(p_retailprice AS BIGINT) AS BIGINT) AS whole_price, p_brand
FROM (SELECT p_partkey, p_name, p_brand, p_retailprice, floor(p_retailprice) AS p_floor FROM part),
     (SELECT 1) WHERE p_retailprice IS NOT NULL""".replace(
    "CAST(CAST(p_retailprice AS BIGINT) AS BIGINT)", "CAST(p_floor AS BIGINT)"))
def typed_projection(spark, sf):
    part = s.table(spark, sf, "part").withColumn("whole_price", F.col("p_retailprice"))
    text = part.select(*[F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_retailprice", "whole_price", "p_brand")])
    declared = {
        "p_partkey": "long", "p_name": "integer", "p_retailprice": "double", "whole_price": "long", "p_brand": "unheard",
        "absent": "double",
    }
    return cast_declared(text, declared)


@query("base_plus_update", """
SELECT o_orderkey, o_totalprice, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def base_plus_update(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    text = orders.select(*[F.col(c).cast("string") for c in orders.columns])
    base = text.filter(F.col("o_orderstatus") == "F").drop("o_orderpriority")
    update = text.filter(F.col("o_orderstatus") != "F")
    return union_update(base, update, {"o_orderkey": "long", "o_totalprice": "double"})


@query("union_by_name_strict", """
SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_by_name_strict(spark, sf):
    left = s.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    right = s.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return left.unionByName(right)


@query("declared_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def declared_filter(spark, sf):
    return apply_filter(s.table(spark, sf, "orders"), {"column": "o_orderstatus", "equals": "F"}).select(
        "o_orderkey", "o_totalprice"
    )


@query("rename_existing_columns", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal FROM supplier")
def rename_existing_columns(spark, sf):
    out = rename_existing(
        s.table(spark, sf, "supplier"), {"s_suppkey": "supplier_id", "s_name": "supplier_name", "absent": "nothing"}
    )
    return out.drop("s_nationkey")


# --- preparation and silver -----------------------------------------------------------------------------------


@query("prepare_weather_dates", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) + 5 AS day,
       CASE WHEN day(ts) + 5 <= 31 THEN make_date(year(ts), month(ts), day(ts) + 5) END AS observation_date
FROM events WHERE event_type IN ('error', 'view')""")
def prepare_weather_dates(spark, sf):
    """Five days later, so that some days do not exist."""
    raw = s.raw_weather(spark, sf).withColumn("day", F.col("day") + 5)
    return prepare(raw, "observation_date_from_ymd").select("year", "month", "day", "observation_date")


@query("prepare_air_quality_columns", """
SELECT 36 AS state_code, CAST(user_id AS INTEGER) AS site_num, CAST(ts AS DATE) AS measurement_date
FROM events WHERE event_type = 'signup'""")
def prepare_air_quality_columns(spark, sf):
    out = prepare(s.raw_air_quality(spark, sf), "air_quality_bronze")
    return out.select("state_code", F.col("Site Num").alias("site_num"), "measurement_date")


@query("prepare_trip_columns", with_standins("""
SELECT vendor_id AS "VendorID", pickup_datetime, dropoff_datetime, taxi_type, pickup_date FROM trips"""))
def prepare_trip_columns(spark, sf):
    out = prepare(s.raw_trips(spark, sf), "normalize_yellow_trips", {"taxi_type": "yellow"})
    return out.select("VendorID", "pickup_datetime", "dropoff_datetime", "taxi_type", "pickup_date")


@query("zones_to_silver", """
SELECT CAST(c_custkey AS INTEGER) AS location_id, COALESCE(r_name, 'UNKNOWN') AS borough, n_name AS zone, c_mktsegment AS service_zone
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey WHERE c_acctbal >= 0""")
def zones_to_silver(spark, sf):
    """One borough name is blanked so that the default has something to fill."""
    raw = s.raw_zones(spark, sf)
    blanked = raw.withColumn("Borough", F.when(F.col("Borough") != "ASIA", F.col("Borough")))
    return s.to_silver(blanked, "taxi_zones")


@query("weather_to_silver", with_standins(f"""
SELECT station_id, obs_timestamp, {rounded('temperature_c', 6)} AS temperature_c, {rounded('wind_speed_ms', 6)} AS wind_speed_ms,
       observation_date, observation_hour, {rounded('humidity', 6)} AS humidity FROM weather"""))
def weather_to_silver(spark, sf):
    out = s.silver_weather(spark, sf)
    return s.wall_clock(
        out.withColumns({c: stable_round(c, 6) for c in ("temperature_c", "wind_speed_ms", "humidity")})
    )


@query("weather_without_humidity", with_standins(f"""
SELECT station_id, obs_timestamp, {rounded('temperature_c', 6)} AS temperature_c, {rounded('wind_speed_ms', 6)} AS wind_speed_ms,
       observation_date, observation_hour FROM weather"""))
def weather_without_humidity(spark, sf):
    """The projection before the schema has evolved."""
    out = s.silver_weather(spark, sf, humidity=False)
    return s.wall_clock(out.withColumns({c: stable_round(c, 6) for c in ("temperature_c", "wind_speed_ms")}))


@query("air_quality_to_silver", with_standins("""
SELECT state_code, county_code, site_num, parameter, value, unit, measurement_timestamp, measurement_date,
       measurement_hour, aqi FROM air_quality"""))
def air_quality_to_silver(spark, sf):
    return s.wall_clock(s.silver_air_quality(spark, sf))


@query("trips_to_silver", with_standins("SELECT * EXCLUDE (fleet) FROM trips"))
def trips_to_silver(spark, sf):
    return s.wall_clock(s.silver_trips(spark, sf))


@query("fill_missing", """
SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'UNKNOWN') AS status,
       COALESCE(CASE WHEN o_totalprice > 100000 THEN o_totalprice END, 0.0) AS price FROM orders""")
def fill_missing(spark, sf):
    holed = s.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )
    return holed.fillna({"status": "UNKNOWN"}).withColumn("price", F.coalesce("price", F.lit(0.0)))


@query("multi_format_timestamp", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'O' THEN o_orderdate END AS parsed FROM orders""")
def multi_format_timestamp(spark, sf):
    """Three spellings by order status, one of them unreadable."""
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.lit("unreadable"))
    )
    return s.wall_clock(
        s.table(spark, sf, "orders").select("o_orderkey", first_timestamp(text).alias("parsed"))
    )


@query("utc_to_local_time", "SELECT event_id, ts - INTERVAL 5 HOUR AS local_ts FROM events")
def utc_to_local_time(spark, sf):
    """All events fall in January, so New York is five hours behind throughout."""
    return s.wall_clock(s.events(spark, sf).select("event_id", utc_to_local(F.col("ts")).alias("local_ts")))


@query("aqi_index", f"""
SELECT event_id, CAST(CAST(LEAST(500, round_even({s.AQI_SQL}, 0)) AS INTEGER) AS VARCHAR) AS aqi FROM events""")
def aqi_index(spark, sf):
    return s.events(spark, sf).select("event_id", pm25_to_aqi(F.col("value") / 10).alias("aqi"))


@query("timestamp_shift", """
SELECT event_id, date_trunc('second', ts) + INTERVAL 90061 SECOND AS shifted FROM events""")
def timestamp_shift(spark, sf):
    return s.wall_clock(s.events(spark, sf).select("event_id", shift_seconds("ts", 90061).alias("shifted")))


@query("recent_window", """
SELECT event_id, ts FROM events WHERE ts > (SELECT MAX(ts) FROM events) - INTERVAL 88 HOUR""")
def recent_window_query(spark, sf):
    return recent_window(s.events(spark, sf).select("event_id", "ts"), "ts", 88)


# --- training input -------------------------------------------------------------------------------------------


@query("training_filter", with_standins("""
SELECT pickup_location_id, pickup_borough, fare_amount, trip_distance FROM integrated
WHERE fare_amount > 0 AND trip_distance > 0.05 AND pickup_borough NOT IN ('Unknown', 'EWR')"""))
def training_filter(spark, sf):
    trips = s.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    return raw_training.training_filter(trips).select(
        "pickup_location_id", "pickup_borough", "fare_amount", "trip_distance"
    )


@query("time_split", with_standins("""
SELECT CASE WHEN pickup_date < DATE '2024-01-15' THEN 'train' WHEN pickup_date < DATE '2024-01-23' THEN 'validation'
       ELSE 'test' END AS part, COUNT(*) AS trips, MIN(pickup_date) AS first_day, MAX(pickup_date) AS last_day
FROM trips GROUP BY 1"""))
def time_split(spark, sf):
    parts = raw_training.time_split(s.silver_trips(spark, sf), date(2024, 1, 15), date(2024, 1, 23))
    labelled = [p.withColumn("part", F.lit(n)) for n, p in zip(("train", "validation", "test"), parts)]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2]).groupBy("part").agg(
        F.count("*").alias("trips"), F.min("pickup_date").alias("first_day"), F.max("pickup_date").alias("last_day")
    )


def _raw_trips_as_text(spark, sf):
    """Trips as text, with the pickup time in one of two spellings."""
    raw = s.raw_trips(spark, sf)
    spelling = F.when(F.col("VendorID") == 1, F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("tpep_pickup_datetime", "MM/dd/yyyy HH:mm:ss")
    )
    return raw.withColumn("tpep_pickup_datetime", spelling).select(*[F.col(c).cast("string") for c in raw.columns])


RAW_TRIPS_CTE = """raw_trips AS (
  SELECT date_trunc('second', pickup_datetime) AS pickup_datetime, pickup_location_id, dropoff_location_id, fare_amount,
         trip_distance, date_trunc('hour', pickup_datetime) AS pickup_hour
  FROM trips WHERE fare_amount > 0 AND trip_distance > 0.05)"""


@query("raw_trip_loader", with_standins("SELECT * FROM raw_trips", RAW_TRIPS_CTE))
def raw_trip_loader(spark, sf):
    out = raw_training.prepare_trips(_raw_trips_as_text(spark, sf))
    return s.wall_clock(out.select(
        "pickup_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount", "trip_distance", "pickup_hour"
    ))


@query("raw_zone_loader", with_standins("""
SELECT CAST(n_nationkey AS INTEGER) AS location_id, MIN(c_mktsegment) AS borough
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""))
def raw_zone_loader(spark, sf):
    customer, nation = s.table(spark, sf, "customer"), s.table(spark, sf, "nation")
    raw = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_nationkey").cast("string").alias("LocationID"), F.col("c_mktsegment").alias("Borough")
    )
    return raw_training.prepare_zones(raw)


@query("raw_weather_loader", with_standins(f"""
SELECT pickup_date + to_hours(pickup_hour) AS weather_hour, {rounded('temperature_c', 6)} AS temperature_c,
       {rounded('wind_speed_ms', 6)} AS wind_speed_ms FROM hourly_weather"""))
def raw_weather_loader(spark, sf):
    out = raw_training.prepare_weather(s.raw_weather(spark, sf))
    return s.wall_clock(out.withColumns({c: stable_round(c, 6) for c in ("temperature_c", "wind_speed_ms")}))


def _raw_air(spark, sf):
    return s.raw_air_quality(spark, sf).withColumnsRenamed({"Date GMT": "Date Local", "Time GMT": "Time Local"})


@query("raw_air_quality_loader", f"""
SELECT date_trunc('hour', ts) AS air_hour, {rounded('AVG(value / 10)', 6)} AS pm25 FROM events WHERE event_type = 'signup' GROUP BY 1""")
def raw_air_quality_loader(spark, sf):
    out = raw_training.prepare_air_quality(_raw_air(spark, sf))
    return s.wall_clock(out.withColumn("pm25", stable_round("pm25", 6)))


@query("raw_enrichment", with_standins(f"""
SELECT t.pickup_datetime, t.pickup_location_id, p.borough AS pickup_borough, COALESCE(d.borough, 'Unknown') AS dropoff_borough,
       {rounded('COALESCE(w.temperature_c, 0)', 6)} AS temperature_c, {rounded('COALESCE(w.wind_speed_ms, 0)', 6)} AS wind_speed_ms,
       {rounded('COALESCE(a.pm25, 0)', 6)} AS pm25, CAST(t.pickup_datetime AS DATE) AS pickup_date
FROM raw_trips t JOIN zones p ON t.pickup_location_id = p.location_id
LEFT JOIN zones d ON t.dropoff_location_id = d.location_id
LEFT JOIN hourly_weather w ON t.pickup_hour = w.pickup_date + to_hours(w.pickup_hour)
LEFT JOIN (SELECT date_trunc('hour', ts) AS air_hour, AVG(value / 10) AS pm25 FROM events WHERE event_type = 'signup' GROUP BY 1) a
  ON t.pickup_hour = a.air_hour""", RAW_TRIPS_CTE))
def raw_enrichment(spark, sf):
    out = raw_training.enrich_raw(
        raw_training.prepare_trips(_raw_trips_as_text(spark, sf)),
        raw_training.prepare_zones(s.raw_zones(spark, sf)),
        raw_training.prepare_weather(s.raw_weather(spark, sf)),
        raw_training.prepare_air_quality(_raw_air(spark, sf)),
    )
    rounded_columns = {c: stable_round(c, 6) for c in ("temperature_c", "wind_speed_ms", "pm25")}
    return s.wall_clock(out.withColumns(rounded_columns).select(
        "pickup_datetime", "pickup_location_id", "pickup_borough", "dropoff_borough", "temperature_c",
        "wind_speed_ms", "pm25", "pickup_date",
    ))


# --- join strategies and partition predicates -----------------------------------------------------------------

CONTEXT_CTE = """context AS (
  SELECT t.pickup_hour, t.fare_amount, t.trip_distance, w.temperature_c FROM trips t
  JOIN hourly_weather w ON t.pickup_date = w.pickup_date AND t.pickup_hour = w.pickup_hour
  WHERE fare_amount > 0 AND trip_distance > 0)"""


def _context(spark, sf):
    hourly = s.silver_weather(spark, sf).groupBy("observation_date", "observation_hour").agg(
        F.avg("temperature_c").alias("temperature_c")
    )
    return hour_context_join(s.silver_trips(spark, sf), hourly)


@query("hour_context_join", with_standins(f"""
SELECT pickup_hour, fare_amount, trip_distance, {rounded('temperature_c', 6)} AS temperature_c FROM context""", CONTEXT_CTE))
def hour_context(spark, sf):
    return _context(spark, sf).select(
        "pickup_hour", "fare_amount", "trip_distance", stable_round("temperature_c", 6).alias("temperature_c")
    )


@query("group_counts_over_shared_frame", with_standins("""
SELECT 'pickup_hour' AS grouping, COUNT(*) AS groups FROM (SELECT DISTINCT pickup_hour FROM context)
UNION ALL SELECT 'temperature', COUNT(*) FROM (SELECT DISTINCT temperature_c FROM context)""", CONTEXT_CTE))
def group_counts_over_shared_frame(spark, sf):
    shared = _context(spark, sf)
    hours = shared.groupBy("pickup_hour").agg(F.avg("fare_amount").alias("m"))
    temperatures = shared.groupBy("temperature_c").agg(F.avg("trip_distance").alias("m"))
    return hours.agg(F.lit("pickup_hour").alias("grouping"), F.count("*").alias("groups")).unionByName(
        temperatures.agg(F.lit("temperature").alias("grouping"), F.count("*").alias("groups"))
    )


ZONE_JOIN_SQL = with_standins("SELECT pickup_location_id, zone, fare_amount FROM trips JOIN zones ON pickup_location_id = location_id")


@query("zone_join_broadcast", ZONE_JOIN_SQL)
def zone_join_broadcast(spark, sf):
    out = broadcast_join(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup_location_id", "location_id")
    return out.select("pickup_location_id", "zone", "fare_amount")


@query("zone_join_merge", ZONE_JOIN_SQL)
def zone_join_merge(spark, sf):
    out = merge_join(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup_location_id", "location_id")
    return out.select("pickup_location_id", "zone", "fare_amount")


@query("trips_on_day", with_standins("""
SELECT pickup_datetime, pickup_location_id, fare_amount FROM trips WHERE pickup_date = DATE '2024-01-09'"""))
def trips_on_day(spark, sf):
    out = on_day(s.silver_trips(spark, sf), "2024-01-09")
    return s.wall_clock(out.select("pickup_datetime", "pickup_location_id", "fare_amount"))
