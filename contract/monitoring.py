"""Run-log reports over a log derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from contract.standins import rounded
from strata.plans import reports

DATASETS = {
    "view": "integrated_taxi_trips", "click": "weather", "purchase": "air_quality_demand_summary",
    "signup": "taxi_zones", "error": "taxi_trips",
}
CASE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DATASETS.items())

RUNS_CTE = f"""WITH runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, ['bronze', 'silver', 'gold'][user_id % 3 + 1] AS layer,
         CASE event_type {CASE_SQL} END AS dataset, ts AS started_at, value AS duration_seconds,
         user_id * 10 AS processed_records, user_id * 9 AS inserted_records, user_id AS rejected_records,
         '1.0' AS schema_version, CASE WHEN value > 40 THEN user_id END AS validation_failures,
         value <= 60 AS validation_ok, CASE WHEN value > 100 THEN 'failed' ELSE 'success' END AS status FROM events),
sourced AS (
  SELECT *, CASE dataset WHEN 'integrated_taxi_trips' THEN 'taxi_trips' WHEN 'air_quality_demand_summary' THEN 'air_quality'
            ELSE dataset END AS source_dataset FROM runs)
"""


def run_log(spark, sf):
    kinds = F.create_map(*[F.lit(x) for pair in DATASETS.items() for x in pair])
    layers = F.array(*[F.lit(x) for x in reports.LAYERS])
    value, user = F.col("value"), F.col("user_id")
    return s.events(spark, sf).select(
        F.col("event_id").cast("string").alias("run_id"),
        F.element_at(layers, (user % 3 + 1).cast("int")).alias("layer"),
        kinds[F.col("event_type")].alias("dataset"),
        F.col("ts").alias("started_at"),
        value.alias("duration_seconds"),
        (user * 10).alias("processed_records"),
        (user * 9).alias("inserted_records"),
        user.alias("rejected_records"),
        F.lit("1.0").alias("schema_version"),
        F.when(value > 40, user).alias("validation_failures"),
        (value <= 60).alias("validation_ok"),
        F.when(value > 100, "failed").otherwise("success").alias("status"),
    )


def _per_layer(template: str) -> str:
    return ", ".join(template.replace("LAYER", layer) for layer in reports.LAYERS)


def _sum_in(column: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN layer = 'LAYER' THEN {column} ELSE 0 END), 0) AS BIGINT)"


def _total(column: str) -> str:
    return f"CAST(COALESCE(SUM({column}), 0) AS BIGINT)"


RUNS_IN = "CAST(SUM(CASE WHEN layer = 'LAYER' THEN 1 ELSE 0 END) AS BIGINT)"


def _seconds_in(function: str) -> str:
    return rounded(f"{function}(CASE WHEN layer = 'LAYER' THEN duration_seconds END)")


@query("source_family", RUNS_CTE + "SELECT dataset, source_dataset, COUNT(*) AS runs FROM sourced GROUP BY 1, 2")
def source_family(spark, sf):
    out = reports.with_source_family(run_log(spark, sf))
    return out.groupBy("dataset", "source_dataset").agg(F.count("*").alias("runs"))


@query("report_execution_times", RUNS_CTE + f"""
SELECT started_at, layer, source_dataset AS dataset, dataset AS recorded_as, {rounded('duration_seconds')} AS execution_time_sec,
       processed_records, inserted_records, rejected_records, schema_version, status FROM sourced""")
def report_execution_times(spark, sf):
    return reports.execution_times(run_log(spark, sf))


@query("report_time_by_layer", RUNS_CTE + f"""
SELECT layer, COUNT(*) AS steps, {rounded('SUM(duration_seconds)')} AS total_execution_time_sec,
       {rounded('AVG(duration_seconds)')} AS avg_execution_time_sec, {rounded('MAX(duration_seconds)')} AS max_execution_time_sec
FROM runs GROUP BY 1""")
def report_time_by_layer(spark, sf):
    return reports.execution_time_by_layer(run_log(spark, sf))


@query("report_most_failing", RUNS_CTE + f"""
SELECT source_dataset AS dataset, COUNT(*) AS failed_runs, {_total('validation_failures')} AS total_validation_failures,
       {_total('rejected_records')} AS total_rejected_records, {_per_layer(RUNS_IN + ' AS LAYER_failed_runs')},
       {_per_layer(_sum_in('validation_failures') + ' AS LAYER_validation_failures')},
       {_per_layer(_sum_in('rejected_records') + ' AS LAYER_rejected_records')}
FROM sourced WHERE validation_failures > 0 OR validation_ok = false GROUP BY 1""")
def report_most_failing(spark, sf):
    return reports.most_failing(run_log(spark, sf))


@query("report_longest_processing", RUNS_CTE + f"""
SELECT source_dataset AS dataset, {rounded('AVG(duration_seconds)')} AS avg_execution_time_sec,
       {rounded('MAX(duration_seconds)')} AS max_execution_time_sec, {rounded('SUM(duration_seconds)')} AS total_execution_time_sec,
       {rounded('AVG(processed_records)', 0)} AS avg_processed_records, COUNT(*) AS runs,
       {_per_layer(_seconds_in('AVG') + ' AS LAYER_avg_sec')}, {_per_layer(_seconds_in('MAX') + ' AS LAYER_max_sec')},
       {_per_layer(RUNS_IN + ' AS LAYER_runs')}
FROM sourced GROUP BY 1""")
def report_longest_processing(spark, sf):
    return reports.longest_processing(run_log(spark, sf))


@query("report_record_counts", RUNS_CTE + f"""
SELECT source_dataset AS dataset, COUNT(*) AS runs, {_total('processed_records')} AS total_processed_records,
       {_total('inserted_records')} AS total_inserted_records, {_total('rejected_records')} AS total_rejected_records,
       {_total('validation_failures')} AS total_validation_failures,
       {_per_layer(_sum_in('processed_records') + ' AS LAYER_processed')},
       {_per_layer(_sum_in('inserted_records') + ' AS LAYER_inserted')},
       {_per_layer(_sum_in('rejected_records') + ' AS LAYER_rejected')}
FROM sourced GROUP BY 1""")
def report_record_counts(spark, sf):
    return reports.record_counts(run_log(spark, sf))


@query("report_processing_time_change", RUNS_CTE + f"""
SELECT source_dataset AS dataset, COUNT(*) AS runs, {rounded('AVG(duration_seconds)')} AS avg_execution_time_sec,
       {rounded('MIN(duration_seconds)')} AS min_execution_time_sec, {rounded('MAX(duration_seconds)')} AS max_execution_time_sec,
       {rounded('SUM(duration_seconds)')} AS total_execution_time_sec,
       {rounded('AVG(CASE WHEN rn_asc = 1 THEN duration_seconds END)')} AS first_execution_time_sec,
       {rounded('AVG(CASE WHEN rn_desc = 1 THEN duration_seconds END)')} AS last_execution_time_sec,
       {_per_layer(_seconds_in('AVG') + ' AS LAYER_avg_sec')},
       MIN(started_at) AS first_started_at, MAX(started_at) AS last_started_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_dataset ORDER BY started_at, run_id) AS rn_asc,
             ROW_NUMBER() OVER (PARTITION BY source_dataset ORDER BY started_at DESC, run_id DESC) AS rn_desc FROM sourced)
GROUP BY 1""")
def report_processing_time_change(spark, sf):
    return reports.processing_time_change(run_log(spark, sf))
