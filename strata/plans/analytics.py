"""Analytical queries over the integrated trips.

Every query works in two steps.  ``fold`` reduces the trips to the query's grain with additive measures, which
Spark combines on the map side before any shuffle, so a zone or an hour that holds a third of all trips costs
no more than any other.  The second step then sees a frame whose size follows the calendar and the zone list and
not the number of trips.  Because the measures are additive, each query accepts either the integrated table or
the shared ``demand_cube`` that the products are built from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import stable_round
from strata.functions.temporal import month_start
from strata.functions.weather import temperature_bin, wind_bin, wind_chill_index

UNKNOWN = "UNKNOWN"

# Distances that count as a real trip in the weather query, and day and tile names.
DISTANCE_LIMITS = (0, 100)
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
TILE_NAMES = ("coldest", "cool", "warm", "warmest")
MIN_TRIPS_PER_HOUR = 10

CUBE_KEYS = (
    "pickup_location_id", "pickup_borough", "pickup_zone", "pickup_date", "pickup_hour", "temperature_c",
    "wind_speed_ms", "pm25", "humidity", "aqi",
)


def _usable_distance() -> Column:
    low, high = DISTANCE_LIMITS
    return (F.col("trip_distance") > low) & (F.col("trip_distance") < high)


def _row_measures(columns: Sequence[str]) -> dict[str, Column]:
    """Additive measures of single trips; only those whose source column is there."""
    out = {"trips": F.count(F.lit(1))}
    if "passenger_count" in columns:
        out["passengers"] = F.sum("passenger_count")
    if "total_amount" in columns:
        out["revenue"] = F.sum("total_amount")
    if "fare_amount" in columns:
        out |= {"fare": F.sum("fare_amount"), "fares": F.count("fare_amount")}
    if "trip_distance" in columns:
        usable = F.when(_usable_distance(), F.col("trip_distance"))
        out |= {
            "distance": F.sum("trip_distance"),
            "distances": F.count("trip_distance"),
            "usable_distance": F.sum(usable),
            "usable_trips": F.count(usable),
        }
    return out


MEASURES = (
    "trips", "passengers", "revenue", "fare", "fares", "distance", "distances", "usable_distance", "usable_trips",
)


def is_cube(df: DataFrame) -> bool:
    return "trips" in df.columns


def fold(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Additive measures per key, from trips or from an already folded frame.  Unused measures are pruned."""
    if is_cube(df):
        measures = {m: F.sum(m) for m in MEASURES if m in df.columns}
    else:
        measures = _row_measures(df.columns)
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def demand_cube(integrated: DataFrame) -> DataFrame:
    """Trips per zone and hour with the hour's weather and air: the common ground of all products."""
    return fold(integrated, [c for c in CUBE_KEYS if c in integrated.columns])


def _mean(total: str, count: str, digits: int = 2) -> Column:
    return stable_round(F.try_divide(F.col(total), F.col(count)), digits)


def _weighted_mean(value: str, weight: str, digits: int) -> Column:
    present = F.when(F.col(value).isNotNull(), F.col(weight))
    return stable_round(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(present)), digits)


# --- the six analytical queries -----------------------------------------------------------------------------


def monthly_zone_demand(df: DataFrame) -> DataFrame:
    """Trips, active days and trips per active day, by month and pickup zone."""
    known = df.filter((F.col("pickup_zone") != UNKNOWN) & F.col("pickup_date").isNotNull())
    zone = ["pickup_location_id", "pickup_borough", "pickup_zone"]
    daily = fold(known, [*zone, "pickup_date"])
    monthly = daily.groupBy(month_start("pickup_date").alias("trip_month"), *zone).agg(
        F.sum("trips").alias("total_trips"), F.count(F.lit(1)).alias("active_days")
    )
    return monthly.withColumn("avg_daily_trips", _mean("total_trips", "active_days")).orderBy(
        F.asc("trip_month"), F.desc("total_trips")
    )


def distance_by_weather(df: DataFrame, computed_at: bool = False) -> DataFrame:
    """Trips and mean distance per temperature and wind bin, with mean humidity once it is recorded."""
    humid = ["humidity"] if computed_at and "humidity" in df.columns else []
    rows = df if is_cube(df) else df.filter(_usable_distance())
    binned = rows.withColumns(
        {"temp_category": temperature_bin("temperature_c"), "wind_category": wind_bin("wind_speed_ms")}
    )
    folded = fold(binned, ["temp_category", "wind_category", *humid]).filter(F.col("usable_trips") > 0)
    measures = [F.sum("usable_trips").alias("trip_count"), F.sum("usable_distance").alias("_distance")]
    if humid:
        measures.append(_weighted_mean("humidity", "usable_trips", 2).alias("avg_humidity_pct"))
    out = folded.groupBy("temp_category", "wind_category").agg(*measures)
    columns = ["temp_category", "wind_category", "trip_count", _mean("_distance", "trip_count").alias("avg_distance_miles")]
    columns += ["avg_humidity_pct"] if humid else []
    columns += [F.current_timestamp().alias("_computed_at")] if computed_at else []
    return out.select(*columns).orderBy("temp_category", "wind_category")


def pm25_demand(df: DataFrame, with_aqi: bool = False) -> DataFrame:
    """Trips, observed hours and trips per hour by rounded PM2.5 level, with the mean index on request."""
    seen = df.filter(F.col("pm25").isNotNull() & F.col("pickup_date").isNotNull() & F.col("pickup_hour").isNotNull())
    aqi = ["aqi"] if with_aqi and "aqi" in df.columns else []
    # One row per level and hour, so hours are counted as rows; the index goes along as a weighted sum.
    trips = F.col("trips") if is_cube(seen) else F.lit(1)
    sums = {"trips": F.sum(trips)}
    if aqi:
        known = F.col("aqi").isNotNull()
        sums |= {"aqi_sum": F.sum(F.when(known, F.col("aqi") * trips)), "aqi_trips": F.sum(F.when(known, trips))}
    hourly = seen.groupBy(stable_round("pm25", 0).alias("pm25_level"), "pickup_date", "pickup_hour").agg(
        *[total.alias(name) for name, total in sums.items()]
    )
    out = hourly.groupBy("pm25_level").agg(
        *[F.sum(name).alias(name) for name in sums], F.count(F.lit(1)).alias("observed_hours")
    )
    if aqi:
        out = out.withColumn("avg_aqi_index", _mean("aqi_sum", "aqi_trips", 0))
    return out.select(
        "pm25_level", *(["avg_aqi_index"] if aqi else []), "trips", "observed_hours",
        _mean("trips", "observed_hours").alias("trips_per_hour"),
    ).orderBy(F.desc("pm25_level"))


def weather_quartiles(df: DataFrame) -> DataFrame:
    """Trips and hours per zone and quartile of its trips, ranked by wind chill (missing weather first).

    A quartile over single trips would sort all trips of a zone in one task.  All trips of a zone within an hour
    share one wind-chill value, so they form a block of known length: running totals over the blocks give the
    positions each block covers, and the quartile borders then split the blocks.  The result equals ``ntile(4)``
    over the trips ordered by wind chill, date and hour, and the window sees one row per zone and hour.
    """
    known = df.filter(
        F.col("pickup_zone").isNotNull() & F.col("pickup_date").isNotNull() & F.col("pickup_hour").isNotNull()
    )
    indexed = known.withColumn("chill", wind_chill_index("wind_speed_ms", "temperature_c"))
    blocks = fold(indexed, ["pickup_zone", "chill", "pickup_date", "pickup_hour"])
    zone = Window.partitionBy("pickup_zone")
    order = zone.orderBy(F.asc_nulls_first("chill"), "pickup_date", "pickup_hour")
    placed = blocks.select(
        "pickup_zone", "pickup_date", "pickup_hour", "trips",
        F.sum("trips").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("trips").over(zone).alias("total"),
    )
    size, extra = F.floor(F.col("total") / 4), F.col("total") % 4
    tile = F.col("tile")
    lower = (tile - 1) * size + F.least(tile - 1, extra)
    upper = tile * size + F.least(tile, extra)
    overlap = F.least(F.col("upto"), upper) - F.greatest(F.col("upto") - F.col("trips"), lower)
    pieces = (
        placed.withColumn("tile", F.explode(F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3, 4)])))
        .withColumn("piece", overlap)
        .filter(F.col("piece") > 0)
    )
    hours = pieces.groupBy("pickup_zone", "tile", "pickup_date", "pickup_hour").agg(F.sum("piece").alias("piece"))
    return hours.groupBy("pickup_zone", "tile").agg(F.sum("piece").alias("trips"), F.count(F.lit(1)).alias("hours"))


def zone_weather_sensitivity(df: DataFrame, min_trips_per_hour: float = MIN_TRIPS_PER_HOUR) -> DataFrame:
    """Trips per hour in each wind-chill quartile of a zone and their spread in percent of the mean.

    The quartile names run against the temperature (see ``wind_chill_index``).
    """
    rates = weather_quartiles(df).withColumn("rate", F.col("trips") / F.col("hours"))
    pivoted = rates.groupBy("pickup_zone").pivot("tile", [1, 2, 3, 4]).agg(stable_round(F.avg("rate"), 2))
    named = pivoted.toDF("pickup_zone", *TILE_NAMES)
    tiles = [F.col(t) for t in TILE_NAMES]
    mean = (tiles[0] + tiles[1] + tiles[2] + tiles[3]) / F.lit(4.0)
    spread = F.try_divide(F.greatest(*tiles) - F.least(*tiles), mean) * 100
    return (
        named.filter(mean >= min_trips_per_hour)
        .withColumn("pct_variation", stable_round(spread, 2))
        .orderBy(F.desc("pct_variation"))
    )


def hourly_by_weekday(df: DataFrame) -> DataFrame:
    """Trips, active days and trips per active day by weekday and hour."""
    seen = df.filter(F.col("pickup_date").isNotNull() & F.col("pickup_hour").isNotNull())
    daily = fold(seen, ["pickup_date", "pickup_hour"])
    return (
        daily.groupBy(F.dayofweek("pickup_date").alias("dow"), "pickup_hour")
        .agg(F.sum("trips").alias("trip_count"), F.count(F.lit(1)).alias("active_days"))
        .withColumn("avg_trips", _mean("trip_count", "active_days"))
    )


def peak_hours_by_weekday(df: DataFrame) -> DataFrame:
    """The busiest hour of each weekday, Monday first; ties go to more trips, then to the earlier hour."""
    order = Window.partitionBy("dow").orderBy(F.desc("avg_trips"), F.desc("trip_count"), F.asc("pickup_hour"))
    top = hourly_by_weekday(df).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1)
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return top.orderBy((F.col("dow") + 5) % 7).select(
        F.element_at(names, F.col("dow")).alias("day_of_week"),
        F.col("pickup_hour").alias("peak_hour"),
        "trip_count", "active_days", "avg_trips",
    )


def monthly_trends(df: DataFrame) -> DataFrame:
    """Average daily trips per month against the month before."""
    daily = fold(df.filter(F.col("pickup_date").isNotNull()), ["pickup_date"])
    monthly = (
        daily.groupBy(month_start("pickup_date").alias("trip_month"))
        .agg(F.sum("trips").alias("total_trips"), F.count(F.lit(1)).alias("active_days"))
        .withColumn("avg_daily_trips", _mean("total_trips", "active_days"))
    )
    # One row per month is left here, so the unpartitioned window stays tiny.
    previous = F.lag("avg_daily_trips").over(Window.orderBy("trip_month"))
    change = F.try_divide(F.lit(100.0) * (F.col("avg_daily_trips") - F.col("prev_month_avg_daily")), "prev_month_avg_daily")
    return (
        monthly.withColumn("prev_month_avg_daily", previous)
        .withColumn("pct_change_vs_prev_month", stable_round(change, 2))
        .orderBy("trip_month")
    )


# --- simple layout queries ----------------------------------------------------------------------------------


def trips_per_borough(df: DataFrame) -> DataFrame:
    return df.groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("trips"))


def average_duration_per_day(df: DataFrame) -> DataFrame:
    """Mean trip duration in minutes by pickup date."""
    seconds = F.timestamp_diff("SECOND", F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return df.groupBy("pickup_date").agg(
        stable_round(F.avg(seconds) / F.lit(60.0), 2).alias("avg_duration_min"), F.count(F.lit(1)).alias("trips")
    )


def average_fare_per_borough(df: DataFrame) -> DataFrame:
    return df.groupBy("pickup_borough").agg(stable_round(F.avg("fare_amount"), 2).alias("avg_fare"))


# --- data products ------------------------------------------------------------------------------------------


def daily_borough_mobility(df: DataFrame) -> DataFrame:
    """Trips, passengers, revenue, mean distance and mean fare by date and borough."""
    known = df.filter((F.col("pickup_borough") != UNKNOWN) & F.col("pickup_date").isNotNull())
    folded = fold(known, ["pickup_date", "pickup_borough"])
    return folded.select(
        "pickup_date", "pickup_borough",
        F.col("trips").alias("total_trips"),
        F.col("passengers").alias("total_passengers"),
        stable_round("revenue", 2).alias("total_revenue"),
        _mean("distance", "distances").alias("avg_distance_miles"),
        _mean("fare", "fares").alias("avg_fare"),
    )


def weather_impact_summary(df: DataFrame) -> DataFrame:
    return distance_by_weather(df, computed_at=True)


def air_quality_demand_summary(df: DataFrame) -> DataFrame:
    return pm25_demand(df, with_aqi=True)


QUERIES = {
    "q1_monthly_zone_demand": monthly_zone_demand,
    "q2_weather_distance": distance_by_weather,
    "q3_pm25_demand": pm25_demand,
    "q4_zone_weather_sensitivity": zone_weather_sensitivity,
    "q5_peak_hours_by_dow": peak_hours_by_weekday,
    "q6_monthly_trends": monthly_trends,
}
