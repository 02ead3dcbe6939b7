"""Reports over the run log.  Each takes the log as a frame, so it also works on a filtered or archived log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.numeric import stable_round
from strata.lake import Lake
from strata.plans.runs import load_runs

LAYERS = ("bronze", "silver", "gold")

# Gold tables and the source family they are counted under.
SOURCE_FAMILIES = {
    "integrated_taxi_trips": "taxi_trips",
    "daily_borough_mobility": "taxi_trips",
    "taxi_zone_monthly_demand": "taxi_trips",
    "zone_weather_sensitivity": "taxi_trips",
    "weather_impact_summary": "weather",
    "air_quality_demand_summary": "air_quality",
}


def with_source_family(runs: DataFrame, families: Mapping[str, str] = SOURCE_FAMILIES) -> DataFrame:
    """Add the source dataset a run belongs to; other names stand for themselves."""
    family = F.col("dataset")
    for name, source in families.items():
        family = F.when(F.col("dataset") == name, source).otherwise(family)
    return runs.withColumn("source_dataset", family)


def _by_family(runs: DataFrame):
    return with_source_family(runs).groupBy(F.col("source_dataset").alias("dataset"))


def _in_layer(layer: str, value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col("layer") == layer, value)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _layer_total(layer: str, column: str) -> Column:
    return F.coalesce(F.sum(_in_layer(layer, column).otherwise(0)), F.lit(0))


def _layer_runs(layer: str) -> Column:
    return F.sum(_in_layer(layer, F.lit(1)).otherwise(0))


def execution_times(runs: DataFrame) -> DataFrame:
    """One row per run, in order of start."""
    return with_source_family(runs).orderBy("started_at").select(
        "started_at", "layer",
        F.col("source_dataset").alias("dataset"),
        F.col("dataset").alias("recorded_as"),
        stable_round("duration_seconds").alias("execution_time_sec"),
        "processed_records", "inserted_records", "rejected_records", "schema_version", "status",
    )


def execution_time_by_layer(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("layer")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            stable_round(F.sum("duration_seconds")).alias("total_execution_time_sec"),
            stable_round(F.avg("duration_seconds")).alias("avg_execution_time_sec"),
            stable_round(F.max("duration_seconds")).alias("max_execution_time_sec"),
        )
        .orderBy(F.desc("total_execution_time_sec"))
    )


def most_failing(runs: DataFrame) -> DataFrame:
    """Source families by number of runs that failed validation, overall and per layer."""
    failed = runs.filter((F.col("validation_failures") > 0) | ~F.col("validation_ok"))
    measures = [
        F.count(F.lit(1)).alias("failed_runs"),
        _total("validation_failures").alias("total_validation_failures"),
        _total("rejected_records").alias("total_rejected_records"),
    ]
    for layer in LAYERS:
        measures += [
            _layer_runs(layer).alias(f"{layer}_failed_runs"),
            _layer_total(layer, "validation_failures").alias(f"{layer}_validation_failures"),
            _layer_total(layer, "rejected_records").alias(f"{layer}_rejected_records"),
        ]
    return _by_family(failed).agg(*measures).orderBy(F.desc("failed_runs"), F.desc("total_validation_failures"))


def longest_processing(runs: DataFrame) -> DataFrame:
    """Source families by processing time, overall and per layer."""
    seconds = "duration_seconds"
    measures = [
        stable_round(F.avg(seconds)).alias("avg_execution_time_sec"),
        stable_round(F.max(seconds)).alias("max_execution_time_sec"),
        stable_round(F.sum(seconds)).alias("total_execution_time_sec"),
        stable_round(F.avg("processed_records"), 0).alias("avg_processed_records"),
        F.count(F.lit(1)).alias("runs"),
    ]
    for layer in LAYERS:
        measures += [
            stable_round(F.avg(_in_layer(layer, seconds))).alias(f"{layer}_avg_sec"),
            stable_round(F.max(_in_layer(layer, seconds))).alias(f"{layer}_max_sec"),
            _layer_runs(layer).alias(f"{layer}_runs"),
        ]
    return _by_family(runs).agg(*measures).orderBy(F.desc("total_execution_time_sec"))


def record_counts(runs: DataFrame) -> DataFrame:
    """Processed, inserted and rejected rows per source family, overall and per layer."""
    measures = [F.count(F.lit(1)).alias("runs")]
    measures += [
        _total(f"{kind}_records").alias(f"total_{kind}_records") for kind in ("processed", "inserted", "rejected")
    ]
    measures.append(_total("validation_failures").alias("total_validation_failures"))
    for layer in LAYERS:
        measures += [
            _layer_total(layer, f"{kind}_records").alias(f"{layer}_{kind}")
            for kind in ("processed", "inserted", "rejected")
        ]
    return _by_family(runs).agg(*measures).orderBy(F.desc("total_rejected_records"), "dataset")


def processing_time_change(runs: DataFrame) -> DataFrame:
    """Processing time per source family with its first and its latest run.

    First and latest come from ``min_by`` and ``max_by``, which combine before the shuffle, instead of numbering
    all runs of a family in one task.
    """
    seconds, when = "duration_seconds", F.struct("started_at", "run_id")
    measures = [
        F.count(F.lit(1)).alias("runs"),
        stable_round(F.avg(seconds)).alias("avg_execution_time_sec"),
        stable_round(F.min(seconds)).alias("min_execution_time_sec"),
        stable_round(F.max(seconds)).alias("max_execution_time_sec"),
        stable_round(F.sum(seconds)).alias("total_execution_time_sec"),
        stable_round(F.min_by(seconds, when)).alias("first_execution_time_sec"),
        stable_round(F.max_by(seconds, when)).alias("last_execution_time_sec"),
    ]
    measures += [stable_round(F.avg(_in_layer(layer, seconds))).alias(f"{layer}_avg_sec") for layer in LAYERS]
    measures += [F.min("started_at").alias("first_started_at"), F.max("started_at").alias("last_started_at")]
    return _by_family(runs).agg(*measures).orderBy(F.desc("total_execution_time_sec"))


REPORTS = {
    "all_pipeline_runs": execution_times,
    "execution_times": execution_times,
    "execution_time_by_layer": execution_time_by_layer,
    "datasets_failing_validation_most": most_failing,
    "datasets_longest_processing": longest_processing,
    "rejects_per_execution": record_counts,
    "processing_time_over_executions": processing_time_change,
}


def monitoring_report(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All reports over a lake's run log; the log is also registered for SQL."""
    runs = load_runs(spark, lake)
    runs.createOrReplaceTempView("pipeline_runs")
    with_source_family(runs).createOrReplaceTempView("pipeline_runs_by_source")
    return {name: report(runs) for name, report in REPORTS.items()}
