"""Timings of the headline jobs and queries, as one JSON line.

A raw area is derived from the driver tables, then the lake is built from it step by step.  Queries run over the
stored integrated table, as a user of the lake would run them.  Every query goes to the ``noop`` sink, so all
columns and the final order are computed, and counts as the median of its runs after one warm-up.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from contract import quality, standins  # noqa: E402
from strata.functions.temporal import shift_seconds  # noqa: E402
from strata.lake import Lake  # noqa: E402
from strata.operators.rules import run_row_checks  # noqa: E402
from strata.plans import analytics, evaluation, gold, reports, runs, silver, training, updates  # noqa: E402
from strata.plans.bronze import ingest_all  # noqa: E402
from strata.sources.tables import read_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
COPIES = int(os.environ.get("BENCH_TRIP_COPIES", "1"))


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("strata-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_raw(spark: SparkSession, lake: Lake) -> None:
    hour = ("year", "month", "day", "hour")
    weather = standins.raw_weather(spark, SF_DIR).groupBy(*hour).agg(
        F.avg("temp").alias("temp"), F.avg("wspd").alias("wspd"), F.avg("humidity").alias("rhum")
    )
    trips = standins.raw_trips(spark, SF_DIR)
    if COPIES > 1:
        # Like for like with published figures: every trip again at other seconds.
        shift = F.col("_copy") * 37
        times = {c: shift_seconds(c, shift).cast(trips.schema[c].dataType) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
        trips = trips.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))).withColumns(times).drop("_copy")
    trips.write.parquet(lake.raw("taxi_trips/yellow"))
    for frame, path in (
        (weather, "weather/weather.csv"),
        (standins.raw_air_quality(spark, SF_DIR).drop("aqi"), "air_quality/hourly_88101_2024.csv"),
        (standins.raw_zones(spark, SF_DIR), "taxi_zones"),
    ):
        frame.write.option("header", True).csv(lake.raw(path))


def once(action) -> float:
    begun = time.perf_counter()
    action()
    return time.perf_counter() - begun


def query_seconds(build) -> float:
    """Median seconds to build and run a query."""
    times = [once(lambda: evaluation.run_fully(build())) for _ in range(REPEATS + 1)]
    return statistics.median(times[1:])


def main() -> None:
    logging.disable(logging.WARNING)
    with tempfile.TemporaryDirectory(prefix="strata-bench-") as scratch:  # one machine: the session is local
        run(scratch)


def run(scratch: str) -> None:
    spark = session(scratch)
    lake = Lake(f"{scratch}/lake")
    write_raw(spark, lake)
    seconds: dict[str, float] = {}

    seconds["bronze_full"] = once(lambda: ingest_all(spark, lake, mode="full"))
    seconds["silver_promote"] = once(lambda: silver.promote_all(spark, lake))
    by_date, by_borough = lake.gold(gold.INTEGRATED), lake.gold(gold.INTEGRATED_BY_BOROUGH)
    seconds["gold_write_both_layouts"] = once(lambda: gold.integrate(spark, lake))
    seconds["product_refresh"] = once(lambda: gold.build_products(spark, lake, force=True))

    for layout, path in (("by_date", by_date), ("by_borough", by_borough)):
        for name, build in (
            ("trips_per_borough", analytics.trips_per_borough),
            ("average_duration_per_day", analytics.average_duration_per_day),
            ("average_fare_per_borough", analytics.average_fare_per_borough),
        ):
            seconds[f"{name}_{layout}"] = query_seconds(lambda: build(read_table(spark, path)))  # noqa: B023
    for name, build in analytics.QUERIES.items():
        seconds[name] = query_seconds(lambda: build(read_table(spark, by_date)))  # noqa: B023
    for product in gold.PRODUCTS:
        seconds[f"read_{product.name}"] = query_seconds(
            lambda: read_table(spark, lake.product(product.name))  # noqa: B023
        )

    checked = run_row_checks(quality.order_lines(spark, SF_DIR), quality.RULES)
    seconds["validation_good_rows"] = query_seconds(lambda: checked.good_df)
    seconds["validation_rejects"] = query_seconds(lambda: checked.rejects_df)
    log = runs.load_runs(spark, lake)
    seconds["monitoring_reports"] = query_seconds(lambda: reports.processing_time_change(log))
    seconds["run_log_append"] = evaluation.logging_overhead(spark, lake, REPEATS)["per_append"]

    for name, taken in evaluation.validation_overhead(spark, lake).items():
        seconds[f"validation_{name}"] = taken
    seconds["generate_updates"] = once(lambda: updates.run_all_generators(spark, lake))
    seconds["bronze_incremental"] = once(
        lambda: ingest_all(spark, lake, evaluation.INCREMENTAL_DATASETS, mode="incremental")
    )
    integrated = read_table(spark, by_date)
    seconds["model_fit"] = once(lambda: training.train(integrated.filter(F.col("fare_amount") > 0)))

    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
