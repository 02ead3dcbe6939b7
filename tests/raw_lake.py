"""A small raw area with every kind of good and bad row."""

from __future__ import annotations

import csv
import os
from datetime import datetime, timedelta

from pyspark.sql import types as T

TRIPS = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("PULocationID", T.LongType()),
    T.StructField("DOLocationID", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

HOURS = 72
GOOD_TRIPS = 400


def good_trip(i: int):
    start = datetime(2024, 1, 10) + timedelta(minutes=10 * i)
    return (
        1 + i % 2, start, start + timedelta(minutes=7 + i % 11), 1 + i % 4, 1.0 + i % 9, 1 + i % 3, 1 + i % 4,
        5.0 + i % 40, 1.0, 0.0, 6.0 + i % 40,
    )


def bad_trips():
    base = list(good_trip(0))
    def variant(**changes):
        row = dict(zip(TRIPS.names, base))
        row.update(tpep_pickup_datetime=datetime(2024, 2, 1, 8), tpep_dropoff_datetime=datetime(2024, 2, 1, 9))
        row.update(changes)
        return tuple(row[n] for n in TRIPS.names)

    return [
        variant(fare_amount=-0.01),
        variant(fare_amount=500.01, trip_distance=200.5),
        variant(tpep_dropoff_datetime=None),
        variant(tpep_dropoff_datetime=datetime(2024, 2, 1, 7)),
        variant(tpep_pickup_datetime=datetime(2023, 12, 31, 23, 59, 59)),
        variant(tpep_pickup_datetime=datetime(2024, 6, 1), tpep_dropoff_datetime=datetime(2024, 6, 1, 1)),
    ]


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def weather_rows(hours=HOURS):
    start = datetime(2024, 1, 10)
    for i in range(hours):
        at = start + timedelta(hours=i)
        yield at.year, at.month, at.day, at.hour, round(-5 + i * 0.4, 1), round(3 + i % 24, 1), 40 + i % 50


AIR_HEADER = [
    "State Code", "County Code", "Site Num", "Parameter Name", "Date GMT", "Time GMT", "Date Local", "Time Local",
    "Sample Measurement", "Units of Measure",
]


def air_rows(hours=HOURS):
    start = datetime(2024, 1, 10)
    for i in range(hours):
        at, local = start + timedelta(hours=i), start + timedelta(hours=i - 5)
        for state, county, site in ((36, 61, 1), (36, 5, 2), (36, 1, 3), (34, 61, 4)):
            yield (
                state, county, site, "PM2.5", at.strftime("%Y-%m-%d"), at.strftime("%H:%M"),
                local.strftime("%Y-%m-%d"), local.strftime("%H:%M"), round(5 + (i * 7 + site) % 30 + 0.5, 1), "ug/m3",
            )


def build(spark, lake):
    trips = [good_trip(i) for i in range(GOOD_TRIPS)] + bad_trips() + [good_trip(3), good_trip(3), good_trip(8)]
    spark.createDataFrame(trips, TRIPS).repartition(3).write.parquet(lake.raw("taxi_trips/yellow"))
    write_csv(
        lake.raw("weather/weather.csv"), ["year", "month", "day", "hour", "temp", "wspd", "rhum"],
        [*weather_rows(), (2024, 2, 30, 1, 5.0, 5.0, 50)],
    )
    write_csv(lake.raw("air_quality/hourly_88101_2024.csv"), AIR_HEADER, air_rows())
    write_csv(
        lake.raw("taxi_zones/lookup.csv"), ["LocationID", "Borough", "Zone", "service_zone"],
        [(1, "Queens", "Astoria", "Boro"), (2, "Manhattan", "Soho", "Yellow"), (3, "Manhattan", "Harlem", ""),
         (3, "Bronx", "Double", "Boro"), ("", "Nowhere", "Nowhere", "x")],
    )
