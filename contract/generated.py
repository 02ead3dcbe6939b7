"""Generated updates and samples.

The random values themselves cannot be compared, so each generator is also registered in a form that reports what is
certain about it: which rows it takes, how far it moves them and the bounds it keeps.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from strata.functions.numeric import pm25_to_aqi
from strata.operators.sampling import fraction_sample, random_rows
from strata.plans import updates


@query("random_rows")
def random_row_sample(spark, sf):
    events = s.events(spark, sf)
    total = events.count()
    return random_rows(events, max(1, math.ceil(total * 0.3)), 7, total)


@query("fraction_sample")
def fraction_sample_query(spark, sf):
    return fraction_sample(s.table(spark, sf, "lineitem"), 0.1, 42)


@query("first_rows")
def first_rows(spark, sf):
    return s.wall_clock(s.silver_trips(spark, sf).limit(5))


@query("noisy_measures")
def noisy_measures(spark, sf):
    return s.events(spark, sf).select("event_id", "value", updates.noisy("value", 0.03, 42).alias("noisy_value"))


@query("trip_update")
def trip_update(spark, sf):
    new, copies, _ = updates.trips_update(s.raw_trips(spark, sf))
    return s.wall_clock(new.withColumn("is_new", F.lit(True)).unionByName(copies.withColumn("is_new", F.lit(False))))


@query("weather_update")
def weather_update(spark, sf):
    raw = s.raw_weather(spark, sf).withColumnRenamed("humidity", "rhum")
    return updates.weather_update(raw)


@query("weather_humidity")
def weather_humidity(spark, sf):
    return updates.with_humidity(s.raw_weather(spark, sf).withColumnRenamed("humidity", "rhum"), 42)


@query("air_quality_update")
def air_quality_update(spark, sf):
    return updates.air_quality_update(s.raw_air_quality(spark, sf).drop("aqi"))


# --- what is certain about them -------------------------------------------------------------------------------


@query("random_rows_are_exact", """
SELECT CAST(ceil(COUNT(*) * 0.3) AS BIGINT) AS rows_taken, CAST(ceil(COUNT(*) * 0.3) AS BIGINT) AS different FROM events""")
def random_rows_are_exact(spark, sf):
    return random_row_sample(spark, sf).agg(
        F.count("*").alias("rows_taken"), F.count_distinct("event_id").alias("different")
    )


@query("fraction_sample_follows_source", "SELECT TRUE AS in_source, TRUE AS fraction_plausible, COUNT(*) AS source_rows FROM lineitem")
def fraction_sample_follows_source(spark, sf):
    """A tenth of the rows, none twice more often than in the table."""
    source = s.table(spark, sf, "lineitem")
    taken = fraction_sample_query(spark, sf)
    counts = taken.withColumn("_n", F.lit(1)).unionByName(source.withColumn("_n", F.lit(-1)))
    surplus = counts.groupBy(*source.columns).agg(F.sum("_n").alias("_n"), F.count_if(F.col("_n") == 1).alias("_taken"))
    rows = F.sum(F.col("_taken") - F.col("_n"))
    return surplus.agg(
        (F.max("_n") <= 0).alias("in_source"), F.sum("_taken").between(rows * 0.08, rows * 0.12).alias("fraction_plausible"),
        rows.cast("bigint").alias("source_rows"),
    )


@query("first_rows_come_from_source", s.with_standins("SELECT least(5, COUNT(*)) AS rows_taken, least(5, COUNT(*)) AS in_source FROM trips"))
def first_rows_come_from_source(spark, sf):
    taken, source = first_rows(spark, sf), s.wall_clock(s.silver_trips(spark, sf)).distinct()
    same = [taken[c].eqNullSafe(source[c]) for c in taken.columns]
    found = taken.join(source, same, "left_semi").agg(F.count("*"))
    return taken.agg(F.count("*").alias("rows_taken")).select("rows_taken", found.scalar().alias("in_source"))


@query("noise_stays_in_bounds", "SELECT event_id, value, TRUE AS in_bounds FROM events")
def noise_stays_in_bounds(spark, sf):
    noisy = updates.noisy("value", 0.03, 42)
    # Half a cent for the rounding on top of the three percent.
    return s.events(spark, sf).select(
        "event_id", "value", (F.abs(noisy - F.col("value")) <= F.col("value") * 0.03 + 0.0051).alias("in_bounds")
    )


@query("trip_update_copies", s.with_standins("""
SELECT CAST(greatest(1, ceil(COUNT(*) * 0.015)) AS BIGINT) AS copies, CAST(greatest(1, ceil(COUNT(*) * 0.015)) AS BIGINT) AS in_source,
       COUNT(*) AS source_rows FROM trips"""))
def trip_update_copies(spark, sf):
    """The injected duplicates are an exact number of rows of the source."""
    source = s.raw_trips(spark, sf)
    _, copies, total = updates.trips_update(source)
    known = source.distinct()
    found = copies.join(known, [copies[c].eqNullSafe(known[c]) for c in source.columns], "left_semi")
    return copies.agg(F.count("*").alias("copies")).select(
        "copies", found.agg(F.count("*")).scalar().alias("in_source"), F.lit(total).cast("bigint").alias("source_rows")
    )


@query("trip_update_follows_source", s.with_standins("""
SELECT TRUE AS after_latest, TRUE AS duration_kept, TRUE AS fraction_plausible, COUNT(*) AS source_rows FROM trips"""))
def trip_update_follows_source(spark, sf):
    """New trips start after the latest source trip and keep their duration; about seven percent are taken."""
    source = s.raw_trips(spark, sf)
    new, _, total = updates.trips_update(source)
    seconds = F.timestamp_diff("SECOND", F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    longest = source.agg(F.max(seconds)).scalar()
    latest = source.agg(F.max("tpep_pickup_datetime")).scalar()
    return new.agg(
        (F.min("tpep_pickup_datetime") > latest).alias("after_latest"),
        F.bool_and(seconds.between(0, longest + 1)).alias("duration_kept"),
        F.count("*").between(int(total * 0.035), int(total * 0.14) + 5).alias("fraction_plausible"),
        F.lit(total).cast("bigint").alias("source_rows"),
    )


@query("weather_update_hours", s.with_standins("""
SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
       CAST(hour(t) AS INTEGER) AS hour, COUNT(*) AS readings
FROM (SELECT obs_timestamp + INTERVAL 89 HOUR AS t FROM weather
      WHERE obs_timestamp > (SELECT MAX(obs_timestamp) FROM weather) - INTERVAL 88 HOUR) GROUP BY ALL"""))
def weather_update_hours(spark, sf):
    return weather_update(spark, sf).groupBy("year", "month", "day", "hour").agg(F.count("*").alias("readings"))


@query("weather_update_limits", s.with_standins("""
SELECT TRUE AS temp_ok, TRUE AS wind_ok, TRUE AS humidity_ok, TRUE AS humidity_known, COUNT(*) AS readings FROM weather
WHERE obs_timestamp > (SELECT MAX(obs_timestamp) FROM weather) - INTERVAL 88 HOUR"""))
def weather_update_limits(spark, sf):
    def within(column, low, high):
        return F.bool_and(F.coalesce(F.col(column).between(low, high), F.lit(True)))

    return weather_update(spark, sf).agg(
        within("temp", -50, 50).alias("temp_ok"), within("wspd", 0, 80).alias("wind_ok"),
        within("humidity", 20, 100).alias("humidity_ok"),
        F.bool_and(F.col("humidity").isNotNull()).alias("humidity_known"), F.count("*").alias("readings"),
    )


@query("air_quality_update_times", """
SELECT CAST(user_id AS INTEGER) AS site, strftime(minute + INTERVAL 1 HOUR, '%Y-%m-%d') AS date_gmt,
       strftime(minute + INTERVAL 1 HOUR, '%H:%M') AS time_gmt, TRUE AS index_fits, TRUE AS noise_fits
FROM (SELECT *, date_trunc('minute', ts) AS minute FROM events WHERE event_type = 'signup')
WHERE minute > (SELECT MAX(date_trunc('minute', ts)) FROM events WHERE event_type = 'signup') - INTERVAL 87 HOUR""")
def air_quality_update_times(spark, sf):
    """One hour later each; the index belongs to the new reading, which lies within both rounds of noise."""
    source = s.raw_air_quality(spark, sf).drop("aqi").withColumn("before", F.col("Sample Measurement"))
    out = updates.air_quality_update(source)
    reading, before = F.col("Sample Measurement"), F.col("before")
    return out.select(
        F.col("Site Num").alias("site"), F.col("Date GMT").alias("date_gmt"), F.col("Time GMT").alias("time_gmt"),
        (F.col("aqi") == pm25_to_aqi("Sample Measurement")).alias("index_fits"),
        (F.abs(reading - before) <= before * 0.08 + 0.002).alias("noise_fits"),
    )
