"""Enrichment, analytical queries and products."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from contract.standins import rounded, with_standins
from strata.operators import enrich
from strata.plans import analytics

TEMP_SQL = """CASE WHEN temperature_c IS NULL THEN 'Unknown' WHEN temperature_c < 0 THEN 'Freezing (<0°C)'
 WHEN temperature_c BETWEEN 0 AND 10 THEN 'Cold (0°C to 10°C)'
 WHEN temperature_c BETWEEN 10.01 AND 20 THEN 'Moderate (10°C to 20°C)' ELSE 'Warm (>20°C)' END"""
WIND_SQL = """CASE WHEN wind_speed_ms IS NULL THEN 'Unknown' WHEN wind_speed_ms < 2 THEN 'Calm (<2 m/s)'
 WHEN wind_speed_ms BETWEEN 2 AND 6 THEN 'Moderate Wind (2-6 m/s)' ELSE 'High Wind (>6 m/s)' END"""


# --- hourly context and enrichment --------------------------------------------------------------------------

HOURLY_WEATHER_SQL = with_standins(f"""
SELECT pickup_date, pickup_hour, {rounded('temperature_c', 6)} AS temperature_c,
       {rounded('wind_speed_ms', 6)} AS wind_speed_ms, {rounded('humidity', 6)} AS humidity FROM hourly_weather""")


@query("hourly_weather", HOURLY_WEATHER_SQL)
def hourly_weather(spark, sf):
    out = enrich.hourly_weather(s.silver_weather(spark, sf))
    measures = ("temperature_c", "wind_speed_ms", "humidity")
    return out.withColumns({c: analytics.stable_round(c, 6) for c in measures})


@query("hourly_air_quality", with_standins(f"""
SELECT pickup_date, pickup_hour, {rounded('pm25', 6)} AS pm25, pm25_unit, {rounded('aqi', 6)} AS aqi FROM hourly_air"""))
def hourly_air_quality(spark, sf):
    out = enrich.hourly_air_quality(s.silver_air_quality(spark, sf))
    return out.withColumns({c: analytics.stable_round(c, 6) for c in ("pm25", "aqi")})


@query("pickup_zone_lookup", with_standins("""
SELECT t.pickup_location_id, t.pickup_date, t.fare_amount, COALESCE(zone, 'UNKNOWN') AS pickup_zone,
       COALESCE(borough, 'UNKNOWN') AS pickup_borough
FROM trips t LEFT JOIN zones ON pickup_location_id = location_id"""))
def pickup_zone_lookup(spark, sf):
    out = enrich.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    return out.select("pickup_location_id", "pickup_date", "fare_amount", "pickup_zone", "pickup_borough")


@query("dropoff_zone_lookup", with_standins("""
SELECT t.pickup_location_id, t.dropoff_location_id, COALESCE(p.zone, 'UNKNOWN') AS pickup_zone,
       COALESCE(d.zone, 'UNKNOWN') AS dropoff_zone, COALESCE(d.borough, 'UNKNOWN') AS dropoff_borough
FROM trips t LEFT JOIN zones p ON pickup_location_id = p.location_id
LEFT JOIN zones d ON dropoff_location_id = d.location_id"""))
def dropoff_zone_lookup(spark, sf):
    zones = s.silver_zones(spark, sf)
    out = enrich.add_zone(enrich.add_zone(s.silver_trips(spark, sf), zones, "pickup"), zones, "dropoff")
    return out.select("pickup_location_id", "dropoff_location_id", "pickup_zone", "dropoff_zone", "dropoff_borough")


@query("trips_with_hourly_weather", with_standins(f"""
SELECT t.pickup_datetime, t.pickup_date, t.pickup_hour, t.fare_amount, {rounded('w.temperature_c', 6)} AS temperature_c,
       {rounded('w.wind_speed_ms', 6)} AS wind_speed_ms
FROM trips t LEFT JOIN hourly_weather w ON t.pickup_date = w.pickup_date AND t.pickup_hour = w.pickup_hour"""))
def trips_with_hourly_weather(spark, sf):
    out = enrich.add_hourly(s.silver_trips(spark, sf), enrich.hourly_weather(s.silver_weather(spark, sf)))
    out = out.withColumns({c: analytics.stable_round(c, 6) for c in ("temperature_c", "wind_speed_ms")})
    return s.wall_clock(
        out.select("pickup_datetime", "pickup_date", "pickup_hour", "fare_amount", "temperature_c", "wind_speed_ms")
    )


@query("trips_with_hourly_air_quality", with_standins(f"""
SELECT t.pickup_datetime, t.pickup_date, t.pickup_hour, {rounded('a.pm25', 6)} AS pm25, a.pm25_unit
FROM trips t LEFT JOIN hourly_air a ON t.pickup_date = a.pickup_date AND t.pickup_hour = a.pickup_hour"""))
def trips_with_hourly_air_quality(spark, sf):
    hourly = enrich.hourly_air_quality(s.silver_air_quality(spark, sf))
    out = enrich.add_hourly(s.silver_trips(spark, sf), hourly).withColumn("pm25", analytics.stable_round("pm25", 6))
    return s.wall_clock(out.select("pickup_datetime", "pickup_date", "pickup_hour", "pm25", "pm25_unit"))


def _integrated_sql(evolved: bool) -> str:
    columns = [c for c in enrich.INTEGRATED_COLUMNS if evolved or c not in enrich.EVOLVED_COLUMNS]
    averaged = ("temperature_c", "wind_speed_ms", "humidity", "pm25", "aqi")
    return "SELECT " + ", ".join(f"{rounded(c, 6)} AS {c}" if c in averaged else c for c in columns) + " FROM integrated"


def _rounded_context(df):
    averaged = ("temperature_c", "wind_speed_ms", "humidity", "pm25", "aqi")
    return s.wall_clock(df.withColumns({c: analytics.stable_round(c, 6) for c in averaged if c in df.columns}))


@query("integrated_trips", with_standins(_integrated_sql(False)))
def integrated_trips(spark, sf):
    return _rounded_context(s.integrated(spark, sf, evolved=False))


@query("integrated_trips_evolved", with_standins(_integrated_sql(True)))
def integrated_trips_evolved(spark, sf):
    return _rounded_context(s.integrated(spark, sf))


@query("integrated_trips_keep_extra", with_standins(
    _integrated_sql(True).replace(rounded("aqi", 6), "CAST(trunc(aqi) AS INTEGER)")))
def integrated_trips_keep_extra(spark, sf):
    df = s.integrated(spark, sf, keep_extra=True)
    averaged = ("temperature_c", "wind_speed_ms", "humidity", "pm25")
    return s.wall_clock(df.withColumns({c: analytics.stable_round(c, 6) for c in averaged}))


# --- analytical queries -------------------------------------------------------------------------------------

MONTHLY_ZONE_SQL = with_standins(f"""
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS trip_month, pickup_location_id, pickup_borough, pickup_zone,
       COUNT(*) AS total_trips, COUNT(DISTINCT pickup_date) AS active_days,
       {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT pickup_date)')} AS avg_daily_trips
FROM order_trips WHERE pickup_zone <> 'UNKNOWN' GROUP BY 1, 2, 3, 4""")


@query("monthly_zone_demand", MONTHLY_ZONE_SQL)
def monthly_zone_demand(spark, sf):
    return analytics.monthly_zone_demand(s.order_trips(spark, sf))


DISTANCE_SQL = with_standins(f"""
SELECT {TEMP_SQL} AS temp_category, {WIND_SQL} AS wind_category, COUNT(*) AS trip_count,
       {rounded('AVG(trip_distance)')} AS avg_distance_miles
FROM integrated WHERE trip_distance > 0 AND trip_distance < 100 GROUP BY 1, 2""")


@query("distance_by_weather", DISTANCE_SQL)
def distance_by_weather(spark, sf):
    trips = enrich.add_hourly(
        s.silver_trips(spark, sf), enrich.hourly_weather(s.silver_weather(spark, sf, humidity=False))
    )
    return analytics.distance_by_weather(trips)


@query("pm25_demand", with_standins(f"""
SELECT {rounded('pm25', 0)} AS pm25_level, COUNT(*) AS trips,
       COUNT(DISTINCT (pickup_date, pickup_hour)) AS observed_hours,
       {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT (pickup_date, pickup_hour))')} AS trips_per_hour
FROM integrated WHERE pm25 IS NOT NULL GROUP BY 1"""))
def pm25_demand(spark, sf):
    hourly = enrich.hourly_air_quality(s.silver_air_quality(spark, sf, aqi=False))
    return analytics.pm25_demand(enrich.add_hourly(s.silver_trips(spark, sf), hourly))


RATES_SQL = """rates AS (
  SELECT pickup_zone, tile, COUNT(*) AS trips, COUNT(DISTINCT (pickup_date, pickup_hour)) AS hours,
         CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT (pickup_date, pickup_hour)) AS rate
  FROM (SELECT pickup_zone, pickup_date, pickup_hour, CAST(NTILE(4) OVER (PARTITION BY pickup_zone ORDER BY
          (10 * sqrt(wind_speed_ms) - wind_speed_ms + 10.5) * (33 - temperature_c) ASC NULLS FIRST,
          pickup_date, pickup_hour) AS BIGINT) AS tile FROM integrated)
  GROUP BY 1, 2)"""


@query("weather_quartiles", with_standins("SELECT pickup_zone, tile, trips, hours FROM rates", RATES_SQL))
def weather_quartiles(spark, sf):
    return analytics.weather_quartiles(s.integrated(spark, sf, evolved=False))


SENSITIVITY_SQL = with_standins(f"""
SELECT pickup_zone, coldest, cool, warm, warmest,
       {rounded('(GREATEST(coldest, cool, warm, warmest) - LEAST(coldest, cool, warm, warmest)) / ((coldest + cool + warm + warmest) / 4.0) * 100')} AS pct_variation
FROM pivoted WHERE (coldest + cool + warm + warmest) / 4.0 >= 0""", RATES_SQL, f"""pivoted AS (
  SELECT pickup_zone, {", ".join(f"MAX(CASE WHEN tile = {i} THEN {rounded('rate')} END) AS {n}" for i, n in
                                 enumerate(analytics.TILE_NAMES, 1))} FROM rates GROUP BY 1)""")


@query("zone_weather_sensitivity", SENSITIVITY_SQL)
def zone_weather_sensitivity(spark, sf):
    return analytics.zone_weather_sensitivity(s.integrated(spark, sf, evolved=False), min_trips_per_hour=0)


PEAK_SQL = with_standins("""
SELECT ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][dow + 1] AS day_of_week,
       pickup_hour AS peak_hour, trip_count, active_days, avg_trips
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dow ORDER BY avg_trips DESC, trip_count DESC, pickup_hour) AS rn FROM by_hour)
WHERE rn = 1""", f"""by_hour AS (
  SELECT dayofweek(pickup_date) AS dow, pickup_hour, COUNT(*) AS trip_count, COUNT(DISTINCT pickup_date) AS active_days,
         {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT pickup_date)')} AS avg_trips
  FROM trips GROUP BY 1, 2)""")


@query("peak_hours_by_weekday", PEAK_SQL)
def peak_hours_by_weekday(spark, sf):
    return analytics.peak_hours_by_weekday(s.silver_trips(spark, sf))


@query("monthly_trends", with_standins(f"""
SELECT trip_month, total_trips, active_days, avg_daily_trips, LAG(avg_daily_trips) OVER (ORDER BY trip_month) AS prev_month_avg_daily,
       {rounded('100.0 * (avg_daily_trips - LAG(avg_daily_trips) OVER (ORDER BY trip_month)) / LAG(avg_daily_trips) OVER (ORDER BY trip_month)')} AS pct_change_vs_prev_month
FROM monthly""", f"""monthly AS (
  SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS trip_month, COUNT(*) AS total_trips,
         COUNT(DISTINCT pickup_date) AS active_days,
         {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT pickup_date)')} AS avg_daily_trips
  FROM order_trips GROUP BY 1)"""))
def monthly_trends(spark, sf):
    return analytics.monthly_trends(s.order_trips(spark, sf))


@query("trips_per_borough", with_standins("SELECT pickup_borough, COUNT(*) AS trips FROM integrated GROUP BY 1"))
def trips_per_borough(spark, sf):
    return analytics.trips_per_borough(enrich.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup"))


@query("average_duration_per_day", with_standins(f"""
SELECT pickup_date, {rounded("AVG(date_diff('microsecond', pickup_datetime, dropoff_datetime) // 1000000) / 60.0")} AS avg_duration_min,
       COUNT(*) AS trips FROM trips GROUP BY 1"""))
def average_duration_per_day(spark, sf):
    return analytics.average_duration_per_day(s.silver_trips(spark, sf))


@query("average_fare_per_borough", with_standins(
    f"SELECT pickup_borough, {rounded('AVG(fare_amount)')} AS avg_fare FROM integrated GROUP BY 1"))
def average_fare_per_borough(spark, sf):
    wide = enrich.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    return analytics.average_fare_per_borough(wide)


# --- data products, built from the shared cube as the product job does ----------------------------------------


@query("product_daily_borough_mobility", with_standins(f"""
SELECT pickup_date, pickup_borough, COUNT(*) AS total_trips, CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
       {rounded('SUM(total_amount)')} AS total_revenue, {rounded('AVG(trip_distance)')} AS avg_distance_miles,
       {rounded('AVG(fare_amount)')} AS avg_fare
FROM integrated WHERE pickup_borough <> 'UNKNOWN' GROUP BY 1, 2"""))
def product_daily_borough_mobility(spark, sf):
    return analytics.daily_borough_mobility(analytics.demand_cube(s.integrated(spark, sf)))


@query("product_zone_monthly_demand", MONTHLY_ZONE_SQL)
def product_zone_monthly_demand(spark, sf):
    return analytics.monthly_zone_demand(analytics.demand_cube(s.order_trips(spark, sf)))


@query("product_weather_impact", with_standins(f"""
SELECT {TEMP_SQL} AS temp_category, {WIND_SQL} AS wind_category, COUNT(*) AS trip_count,
       {rounded('AVG(trip_distance)')} AS avg_distance_miles, {rounded('AVG(humidity)')} AS avg_humidity_pct
FROM integrated WHERE trip_distance > 0 AND trip_distance < 100 GROUP BY 1, 2"""))
def product_weather_impact(spark, sf):
    return analytics.weather_impact_summary(analytics.demand_cube(s.integrated(spark, sf))).drop("_computed_at")


@query("product_air_quality_demand", with_standins(f"""
SELECT {rounded('pm25', 0)} AS pm25_level, {rounded('AVG(aqi)', 0)} AS avg_aqi_index, COUNT(*) AS trips,
       COUNT(DISTINCT (pickup_date, pickup_hour)) AS observed_hours,
       {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT (pickup_date, pickup_hour))')} AS trips_per_hour
FROM integrated WHERE pm25 IS NOT NULL GROUP BY 1"""))
def product_air_quality_demand(spark, sf):
    return analytics.air_quality_demand_summary(analytics.demand_cube(s.integrated(spark, sf)))


@query("product_zone_weather_sensitivity", SENSITIVITY_SQL)
def product_zone_weather_sensitivity(spark, sf):
    cube = analytics.demand_cube(s.integrated(spark, sf, evolved=False))
    return analytics.zone_weather_sensitivity(cube, min_trips_per_hour=0)


# --- the plain aggregate and window operators behind them -----------------------------------------------------


@query("count_distinct_ratio", f"""
SELECT l_returnflag, COUNT(*) AS line_count, COUNT(DISTINCT l_orderkey) AS orders,
       {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT l_orderkey)')} AS lines_per_order
FROM lineitem GROUP BY 1""")
def count_distinct_ratio(spark, sf):
    lines = s.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_orderkey").agg(F.count("*").alias("n"))
    return lines.groupBy("l_returnflag").agg(
        F.sum("n").alias("line_count"), F.count("*").alias("orders"),
        analytics.stable_round(F.sum("n") / F.count("*")).alias("lines_per_order"),
    )


@query("distinct_hours_by_type", """
SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT (CAST(ts AS DATE), hour(ts))) AS hours FROM events GROUP BY 1""")
def distinct_hours_by_type(spark, sf):
    return s.events(spark, sf).groupBy("event_type").agg(
        F.count("*").alias("events"), F.count_distinct(F.struct(F.to_date("ts"), F.hour("ts"))).alias("hours")
    )


@query("quantity_by_status_pivot", f"""
SELECT l_returnflag, MAX(CASE WHEN l_linestatus = 'F' THEN m END) AS final, MAX(CASE WHEN l_linestatus = 'O' THEN m END) AS open
FROM (SELECT l_returnflag, l_linestatus, {rounded('AVG(l_quantity)')} AS m FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def quantity_by_status_pivot(spark, sf):
    lines = s.table(spark, sf, "lineitem")
    pivoted = lines.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"])
    return pivoted.agg(analytics.stable_round(F.avg("l_quantity"))).toDF("l_returnflag", "final", "open")


@query("mean_and_sum_by_location_hour", with_standins(f"""
SELECT pickup_location_id, pickup_hour, {rounded('AVG(fare_amount)')} AS avg_fare, {rounded('SUM(trip_distance)')} AS sum_distance
FROM trips GROUP BY 1, 2"""))
def mean_and_sum_by_location_hour(spark, sf):
    out = s.silver_trips(spark, sf).groupBy("pickup_location_id", "pickup_hour").agg(
        {"fare_amount": "avg", "trip_distance": "sum"}
    )
    return out.select(
        "pickup_location_id", "pickup_hour",
        analytics.stable_round("avg(fare_amount)").alias("avg_fare"),
        analytics.stable_round("sum(trip_distance)").alias("sum_distance"),
    )


@query("pickup_range", with_standins("""
SELECT MIN(pickup_datetime) AS first_pickup, MAX(pickup_datetime) AS last_pickup, COUNT(*) AS trips FROM trips"""))
def pickup_range(spark, sf):
    return s.wall_clock(s.silver_trips(spark, sf).agg(
        F.min("pickup_datetime").alias("first_pickup"), F.max("pickup_datetime").alias("last_pickup"),
        F.count("*").alias("trips"),
    ))


@query("weekday_hours_sorted", with_standins("SELECT dow + 1 AS dow, pickup_hour, trip_count, active_days, avg_trips FROM by_hour", f"""by_hour AS (
  SELECT CAST(dayofweek(pickup_date) AS INTEGER) AS dow, pickup_hour, COUNT(*) AS trip_count, COUNT(DISTINCT pickup_date) AS active_days,
         {rounded('CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT pickup_date)')} AS avg_trips
  FROM trips GROUP BY 1, 2)"""))
def weekday_hours_sorted(spark, sf):
    return analytics.hourly_by_weekday(s.silver_trips(spark, sf)).orderBy(F.asc("dow"), F.desc("avg_trips"))
