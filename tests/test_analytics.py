"""Analytical queries against brute force over single trips."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.compare import same_rows
from strata.operators.enrich import build_integrated
from strata.operators.sampling import random_rows
from strata.plans import analytics

SCHEMA = (
    "pickup_location_id int, pickup_zone string, pickup_borough string, pickup_datetime timestamp_ntz, "
    "dropoff_datetime timestamp_ntz, pickup_date date, pickup_hour int, passenger_count int, trip_distance double, "
    "fare_amount double, total_amount double, temperature_c double, wind_speed_ms double, pm25 double, humidity double, "
    "aqi double"
)


def make_trips(n=3000):
    """A third of the trips share one zone and one hour."""
    draw = random.Random(11)
    weather = {}
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        day = 0 if hot else draw.randrange(70)
        hour = 8 if hot else draw.randrange(24)
        zone = "Z1" if hot else draw.choice(["Z1", "Z2", "Z3", "UNKNOWN"])
        when = date(2024, 1, 1) + timedelta(days=day)
        if (when, hour) not in weather:
            missing = draw.random() < 0.1
            weather[when, hour] = (
                None if missing else round(draw.uniform(-5, 25), 1), None if missing else round(draw.uniform(0, 9), 1),
                None if draw.random() < 0.1 else round(draw.uniform(0, 9), 1), round(draw.uniform(30, 90), 1),
                None if draw.random() < 0.2 else float(draw.randrange(100)),
            )
        temperature, wind, pm25, humidity, aqi = weather[when, hour]
        start = datetime.combine(when, datetime.min.time()) + timedelta(hours=hour)
        rows.append((
            int(zone[-1]) if zone[0] == "Z" else 99, zone, "UNKNOWN" if zone == "UNKNOWN" else "B" + zone[-1], start,
            start + timedelta(seconds=draw.randrange(3600)), when, hour, draw.choice([None, 1, 2]),
            draw.choice([0.0, 1.5, 2.25, 150.0, None]), round(draw.uniform(1, 60), 2), round(draw.uniform(1, 80), 2),
            temperature, wind, pm25, humidity, aqi,
        ))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_trips()


@pytest.fixture(scope="module")
def trips(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(8)


def records(rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return [dict(zip(names, r)) for r in rows]


@pytest.mark.parametrize("query", [
    analytics.monthly_zone_demand, analytics.distance_by_weather, analytics.pm25_demand,
    analytics.air_quality_demand_summary, analytics.peak_hours_by_weekday, analytics.monthly_trends,
    analytics.daily_borough_mobility, analytics.weather_quartiles,
    lambda df: analytics.weather_impact_summary(df).drop("_computed_at"),
    lambda df: analytics.zone_weather_sensitivity(df, 0),
])
def test_cube_gives_the_same_answer_as_the_trips(trips, query):
    assert same_rows(query(trips), query(analytics.demand_cube(trips)))


def test_quartiles_equal_ranking_single_trips(trips, rows):
    by_zone = defaultdict(list)
    for r in records(rows):
        index = None
        if r["temperature_c"] is not None and r["wind_speed_ms"] is not None:
            w = r["wind_speed_ms"]
            index = (10 * math.sqrt(w) - w + 10.5) * (33 - r["temperature_c"])
        key = (index is not None, index or 0, r["pickup_date"], r["pickup_hour"])
        by_zone[r["pickup_zone"]].append(key)
    want = {}
    for zone, entries in by_zone.items():
        entries.sort()
        size, extra = divmod(len(entries), 4)
        position = 0
        for tile in range(1, 5):
            part = entries[position:position + size + (tile <= extra)]
            position += len(part)
            want[zone, tile] = (len(part), len({e[2:] for e in part}))
    got = {(r["pickup_zone"], r["tile"]): (r["trips"], r["hours"]) for r in analytics.weather_quartiles(trips).collect()}
    assert got == want


def test_threshold_uses_the_mean_of_the_quartiles(trips):
    everything = {r["pickup_zone"]: r for r in analytics.zone_weather_sensitivity(trips, 0).collect()}
    busy = analytics.zone_weather_sensitivity(trips).collect()
    mean = {z: sum(r[t] for t in analytics.TILE_NAMES) / 4 for z, r in everything.items()}
    assert {r["pickup_zone"] for r in busy} == {z for z, m in mean.items() if m >= 10}


def test_distance_limits_are_open(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1.0), (0.01, 1.0, 1.0), (99.99, 1.0, 1.0), (100.0, 1.0, 1.0), (None, 1.0, 1.0)],
                               "trip_distance double, temperature_c double, wind_speed_ms double")
    row = analytics.distance_by_weather(df).first()
    assert (row["trip_count"], row["avg_distance_miles"]) == (2, 50.0)


def test_peak_hours_monday_first(trips):
    days = [r["day_of_week"] for r in analytics.peak_hours_by_weekday(trips).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_trend_changes(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1),)] * 4 + [(date(2024, 2, d),) for d in (1, 2) for _ in range(3)] + [(None,)], "pickup_date date")
    got = [tuple(r)[1:] for r in analytics.monthly_trends(df).collect()]
    assert got == [(4, 1, 4.0, None, None), (6, 2, 3.0, 4.0, -25.0)]


def test_duration_and_fare(spark):
    start = datetime(2024, 1, 1, 8)
    df = spark.createDataFrame(
        [("B", start.date(), start, start + timedelta(minutes=10), 10.0), ("B", start.date(), start, start + timedelta(minutes=5), 5.05)],
        "pickup_borough string, pickup_date date, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, fare_amount double")
    assert analytics.average_duration_per_day(df).first()["avg_duration_min"] == 7.5
    assert analytics.average_fare_per_borough(df).first()["avg_fare"] == 7.53
    assert analytics.trips_per_borough(df).first()["trips"] == 2


def integrated_inputs(spark, humidity=False):
    trips = spark.createDataFrame(
        [("yellow", 1, datetime(2024, 1, 1, 8, 5), datetime(2024, 1, 1, 8, 9), 1, 1.0, 1, 9, 5.0, 0.0, 0.0, 5.0, date(2024, 1, 1), 8),
         ("yellow", 1, datetime(2024, 1, 1, 9, 5), datetime(2024, 1, 1, 9, 9), 1, 1.0, 2, 1, 5.0, 0.0, 0.0, 5.0, date(2024, 1, 1), 9)],
        "taxi_type string, vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count int, "
        "trip_distance double, pickup_location_id int, dropoff_location_id int, fare_amount double, tip_amount double, "
        "tolls_amount double, total_amount double, pickup_date date, pickup_hour int")
    weather = spark.createDataFrame([(date(2024, 1, 1), 8, 1.0, 2.0, 50.0), (date(2024, 1, 1), 8, 3.0, 4.0, 60.0)],
                                    "observation_date date, observation_hour int, temperature_c double, wind_speed_ms double, humidity double")
    air = spark.createDataFrame([(61, date(2024, 1, 1), 8, 10.0, "ug"), (1, date(2024, 1, 1), 8, 90.0, "ug")],
                                "county_code int, measurement_date date, measurement_hour int, value double, unit string")
    zones = spark.createDataFrame([(1, "Queens", "Astoria"), (2, "Bronx", None)], "location_id int, borough string, zone string")
    return trips, weather if humidity else weather.drop("humidity"), air, zones


def test_integrated_row(spark):
    df = build_integrated(*integrated_inputs(spark))
    assert len(df.columns) == 22 and df.columns[-2:] == ["pickup_date", "pickup_hour"]
    first, second = sorted(df.collect(), key=lambda r: r["pickup_hour"])
    assert (first["pickup_zone"], first["dropoff_zone"], first["temperature_c"], first["pm25"]) == ("Astoria", "UNKNOWN", 2.0, 10.0)
    assert (second["pickup_zone"], second["pickup_borough"], second["temperature_c"], second["pm25"]) == ("UNKNOWN", "Bronx", None, None)


def test_integrated_evolves(spark):
    df = build_integrated(*integrated_inputs(spark, humidity=True))
    assert df.columns.index("humidity") == df.columns.index("pm25") - 1
    assert "aqi" not in df.columns


def test_enrichment_is_the_same_without_broadcast(spark):
    small = build_integrated(*integrated_inputs(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build_integrated(*integrated_inputs(spark))
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert same_rows(small, shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("n", [0, 10, 5_000, 59_999, 70_000])
def test_random_rows_are_exact(spark, n, monkeypatch):
    from strata.operators import sampling

    monkeypatch.setattr(sampling, "ROWS_PER_SLICE", 500)
    df = spark.range(0, 60_000, 1, 8)
    got = random_rows(df, n, 3)
    assert got.count() == min(n, 60_000) == got.distinct().count()


def test_same_rows_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert same_rows(a, a.orderBy(F.desc("x")))
    assert not same_rows(a, a.distinct()) and not same_rows(a, a.withColumnRenamed("x", "y"))
