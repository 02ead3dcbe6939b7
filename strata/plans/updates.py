"""Synthetic incremental updates, generated where the data lies.

Each generator is a transformation of the source table; nothing is collected, so an update of a few percent of a
very large source is itself a distributed write.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import DEFAULT_DIRECTORY, load_dataset
from strata.functions.numeric import clamp, pm25_to_aqi, relative_noise
from strata.functions.temporal import date_and_time, shift_seconds, timestamp_from_parts
from strata.lake import Lake
from strata.operators.sampling import fraction_sample, random_rows
from strata.plans.concurrent import side_by_side

# Fractions that make sense for an update, the year taken, noise and limits per measure.
NEW_FRACTION = (0.05, 0.10)
DUPLICATE_FRACTION = (0.01, 0.02)
TRIP_YEAR = (date(2024, 1, 1), date(2025, 1, 1))
TRIP_NOISE = 0.03
HOURS_PER_YEAR = 8760
WEATHER_NOISE = 0.03
WEATHER_LIMITS = {
    "temp": (-50.0, 50.0),
    "wspd": (0.0, 80.0),
    "prcp": (0.0, 50.0),
    "pres": (950.0, 1050.0),
    "rhum": (20.0, 100.0),
}
HUMIDITY_LIMITS = (20.0, 100.0)
HUMIDITY_NOISE = 0.02
HUMIDITY_IF_MISSING = (40.0, 85.0)
STATE_CODE = 36
AIR_SHIFT_SECONDS = 3600
AIR_NOISE = 0.025
AIR_EXTRA_NOISE = 0.05


@dataclass(frozen=True)
class UpdateReport:
    """What a generator wrote."""

    dataset: str
    path: str
    source_rows: int
    new_rows: int
    duplicates: int
    period_start: datetime | None
    period_end: datetime | None


def _check(name: str, value: float, bounds: tuple[float, float]) -> None:
    if not bounds[0] <= value <= bounds[1]:
        raise ValueError(f"{name} must be between {bounds[0]:.2f} and {bounds[1]:.2f}")


def noisy(column: str, half_width: float, seed: int, digits: int = 2) -> Column:
    """Multiplicative noise, rounded."""
    return F.round(relative_noise(column, half_width, seed), digits)


def recent_window(df: DataFrame, time_column: str, hours: int) -> DataFrame:
    """Rows of the last ``hours`` before the latest one, over the whole table.

    The latest time is a scalar subquery, so the frame is filtered without a join and without a driver round trip.
    The window is open at its start; the latest row itself is always inside, so it is empty only for empty input.
    """
    latest = df.agg(F.max(time_column)).scalar()
    return df.filter(F.col(time_column) > latest - F.make_dt_interval(hours=F.lit(hours)))


def window_hours(fraction: float) -> int:
    """Length of an update in hours for a yearly hourly source."""
    return max(1, math.ceil(HOURS_PER_YEAR * fraction))


def trips_in_year(trips: DataFrame, bounds: tuple[date, date] = TRIP_YEAR) -> DataFrame:
    kind = trips.schema["tpep_pickup_datetime"].dataType
    low, high = (F.lit(str(b)).cast(kind) for b in bounds)
    return trips.filter((F.col("tpep_pickup_datetime") >= low) & (F.col("tpep_pickup_datetime") < high))


def shifted_trips(sample: DataFrame, shift: int, seed: int) -> DataFrame:
    """Sampled trips moved by ``shift`` seconds with jittered measures."""
    times = {c: shift_seconds(c, shift) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    kinds = {c: sample.schema[c].dataType for c in times}
    measures = {
        c: noisy(c, TRIP_NOISE, seed + i) for i, c in enumerate(("trip_distance", "fare_amount", "total_amount"))
    }
    return sample.withColumns({c: t.cast(kinds[c]) for c, t in times.items()} | measures)


def trips_update(
    trips: DataFrame,
    new_fraction: float = 0.07,
    duplicate_fraction: float = 0.015,
    seed: int = 42,
    bounds: tuple[date, date] = TRIP_YEAR,
) -> tuple[DataFrame, DataFrame, int]:
    """New trips after the latest one, exact copies of existing ones, and the number of source rows within ``bounds``."""
    _check("new_fraction", new_fraction, NEW_FRACTION)
    _check("duplicate_fraction", duplicate_fraction, DUPLICATE_FRACTION)
    valid = trips_in_year(trips, bounds)
    pickup = F.unix_timestamp(F.col("tpep_pickup_datetime").cast("timestamp"))
    total, latest = valid.agg(F.count(F.lit(1)), F.max(pickup)).first()
    if latest is None:
        raise ValueError(f"no trip starts between {bounds[0]} and {bounds[1]}, so there is nothing to follow")
    sample = fraction_sample(valid, new_fraction, seed)
    earliest = sample.agg(F.min(pickup)).first()[0]
    shift = latest - (earliest if earliest is not None else latest) + 3600
    copies = max(1, math.ceil(total * duplicate_fraction))
    return shifted_trips(sample, shift, seed), random_rows(valid, copies, seed + 3, total), total


def weather_update(weather: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """The latest window of hourly weather moved behind the latest hour, jittered, with humidity added."""
    timed = weather.withColumn("_at", timestamp_from_parts("year", "month", "day", "hour")).filter(
        F.col("_at").isNotNull()
    )
    hours = window_hours(fraction)
    # From (latest - hours) to (latest + one hour): the window follows on without a gap.
    moved = recent_window(timed, "_at", hours).withColumn("_at", shift_seconds("_at", (hours + 1) * 3600))
    parts = {"year": F.year("_at"), "month": F.month("_at"), "day": F.dayofmonth("_at"), "hour": F.hour("_at")}
    jittered = {
        c: clamp(F.round(relative_noise(F.col(c).try_cast("double"), WEATHER_NOISE, seed + i), 3), *limits)
        for i, (c, limits) in enumerate(WEATHER_LIMITS.items())
        if c in weather.columns
    }
    return with_humidity(moved.withColumns(parts | jittered), seed + 10).drop("_at")


def with_humidity(weather: DataFrame, seed: int) -> DataFrame:
    """Humidity from the relative humidity with a little noise; a plausible random value where it is missing."""
    low, high = HUMIDITY_IF_MISSING
    guess = F.lit(low) + F.rand(seed) * F.lit(high - low)
    known = F.col("rhum").try_cast("double") if "rhum" in weather.columns else F.lit(None).cast("double")
    humidity = relative_noise(F.coalesce(known, guess), HUMIDITY_NOISE, seed + 1)
    return weather.withColumn("humidity", F.round(clamp(humidity, *HUMIDITY_LIMITS), 1))


def air_quality_update(
    air: DataFrame, fraction: float = 0.01, state_code: int = STATE_CODE, seed: int = 42
) -> DataFrame:
    """One state's latest window one hour later, with noise on the reading and the index derived from it."""
    own = air.filter(F.col("State Code").try_cast("int") == state_code)
    timed = own.withColumn("_at", date_and_time("Date GMT", "Time GMT")).filter(F.col("_at").isNotNull())
    hours = max(1, int(HOURS_PER_YEAR * fraction))
    moved = recent_window(timed, "_at", hours).withColumn("_at", shift_seconds("_at", AIR_SHIFT_SECONDS))
    reading = F.col("Sample Measurement").try_cast("double")
    first = F.round(relative_noise(reading, AIR_NOISE, seed), 3)
    second = F.round(clamp(relative_noise(first, AIR_EXTRA_NOISE, seed + 1), 0.0, None), 3)
    return (
        moved.withColumns(
            {
                "Date GMT": F.date_format("_at", "yyyy-MM-dd"),
                "Time GMT": F.date_format("_at", "HH:mm"),
                "Sample Measurement": second,
            }
        )
        .withColumn("aqi", pm25_to_aqi("Sample Measurement"))
        .drop("_at")
    )


def write_observed(df: DataFrame, path: str, fmt: str, **figures: Column) -> dict:
    """Write an update and take figures of what was written in the same pass; ``_``-columns are not written.

    The figures are taken above the last shuffle, where a retried task is not counted twice.
    """
    seen = Observation()
    kept = [c for c in df.columns if not c.startswith("_")]
    framed = df.hint("rebalance").observe(seen, *[column.alias(name) for name, column in figures.items()]).select(*[F.col(f"`{c}`") for c in kept])
    framed.write.mode("overwrite").format(fmt).option("header", True).save(path)
    return seen.get


def run_all_generators(
    spark: SparkSession, lake: Lake, seed: int = 42, config_dir: Path | str = DEFAULT_DIRECTORY
) -> list[UpdateReport]:
    """Generate the three updates where the configuration of their datasets expects them, side by side, and report on each.

    The figures are taken while the update is written, so they describe exactly what was stored.
    """
    declared = {name: load_dataset(name, config_dir) for name in ("taxi_trips", "weather", "air_quality")}
    target = {name: lake.raw(cfg.update_path) for name, cfg in declared.items()}

    def raw_csv(name: str) -> DataFrame:
        return spark.read.option("header", True).csv(lake.raw(declared[name].path))

    def trips() -> UpdateReport:
        source = spark.read.parquet(lake.raw(declared["taxi_trips"].path))
        new, copies, total = trips_update(source, seed=seed)
        both = new.withColumn("_new", F.lit(True)).unionByName(copies.withColumn("_new", F.lit(False)))
        pickup = F.when(F.col("_new"), F.col("tpep_pickup_datetime"))
        seen = write_observed(
            both, target["taxi_trips"], "parquet", fresh=F.count_if("_new"), repeats=F.count_if(~F.col("_new")), start=F.min(pickup), end=F.max(pickup)
        )
        return UpdateReport("taxi_trips", target["taxi_trips"], total, seen["fresh"], seen["repeats"], seen["start"], seen["end"])

    def hourly(name: str, make, at: Column, counted: Column) -> UpdateReport:
        source = raw_csv(name)
        seen = write_observed(make(source, seed=seed), target[name], "csv", rows=F.count(F.lit(1)), start=F.min(at), end=F.max(at))
        return UpdateReport(name, target[name], source.filter(counted).count(), seen["rows"], 0, seen["start"], seen["end"])

    made = side_by_side(spark, {
        "taxi_trips": trips,
        "weather": lambda: hourly("weather", weather_update, timestamp_from_parts("year", "month", "day", "hour"), F.lit(True)),
        "air_quality": lambda: hourly(
            "air_quality", air_quality_update, date_and_time("Date GMT", "Time GMT"), F.col("State Code").try_cast("int") == STATE_CODE
        ),
    })
    return [made[name] for name in declared]
