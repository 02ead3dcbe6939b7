"""Plan checks: what must and must not show up in the physical plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from contract import quality, standins
from contract.registry import QUERIES
from strata.operators import keys
from strata.operators.compare import same_rows
from strata.operators.lookup import auto_broadcast_bytes
from strata.plans import analytics

SF = "/root/testdata/sf0.001"
GENERATED = {"fare_predictions", "feature_vectors", "feature_vectors_are_standardised", "fare_predictions_beat_the_mean",
             "median_imputation", "median_imputation_fills", "random_rows", "random_rows_are_exact", "trip_update"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - GENERATED))
def test_no_python_workers_and_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct", plan)
    assert "BroadcastNestedLoopJoin" not in plan


def test_good_rows_are_filtered_at_the_scan(spark):
    from strata.operators.rules import run_row_checks

    plan = plan_of(run_row_checks(quality.order_lines(spark, SF), quality.RULES).good_df)
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") == 2
    scans = run_row_checks(quality.order_lines(spark, SF), quality.RULES).good_df._jdf.queryExecution().executedPlan().initialPlan().collectLeaves()
    pushed = [scans.apply(i).verboseStringWithOperatorId() for i in range(scans.size())]
    assert any(re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_extendedprice,1000.0\)", p) for p in pushed)


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(analytics.peak_hours_by_weekday(standins.silver_trips(spark, SF)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "event_type"}


def test_quartiles_rank_blocks_not_trips(spark):
    plan = plan_of(analytics.weather_quartiles(standins.integrated(spark, SF)))
    window = plan.index("Window [")
    assert "HashAggregate" in plan[window:], "trips are folded before the window"


def test_few_repeated_keys_leave_the_rows_where_they_are(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 990).alias("k"), F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    keys.repeated_keys(rows, ["k"]).write.parquet(str(tmp_path / "keys"))
    repeated = spark.read.parquet(str(tmp_path / "keys"))
    first = keys.first_given_repeated(rows, ["k"], repeated)
    single = plan_of(first).split("Union")[1].split("Window")[0]
    assert "Exchange hashpartitioning" not in single and "LeftAnti" in single
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, keys.first_per_key(rows, ["k"]).collect()))
    assert keys.repeats_per_key(rows, ["k"], repeated=repeated).count() == 10


def test_threshold_spellings(spark):
    df = spark.range(1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in (("-1", 0), ("10485760", 10485760), ("10m", 10485760), ("2KB", 2048), ("10485760b", 10485760)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert auto_broadcast_bytes(df) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("build", [analytics.pm25_demand, analytics.peak_hours_by_weekday, analytics.monthly_trends])
def test_folded_queries_gather_no_rows_in_one_task(spark, build):
    plan = plan_of(build(standins.integrated(spark, SF)))
    assert "REPARTITION_BY_NUM" not in plan and "distinct" not in plan


def test_hourly_tables_are_computed_once(spark, tmp_path):
    """The wide write reads the staged hourly tables, not the readings."""
    from strata.operators.enrich import context_tables, enrich
    from strata.sources.tables import read_table, write_table

    trips, weather, air, zones = (
        standins.silver_trips(spark, SF), standins.silver_weather(spark, SF), standins.silver_air_quality(spark, SF),
        standins.silver_zones(spark, SF),
    )
    zones, *hourly = context_tables(weather, air, zones)
    staged = [read_table(spark, write_table(h, str(tmp_path / f"h{i}"))) for i, h in enumerate(hourly)]
    plan = plan_of(enrich(trips, zones, *staged))
    assert "Aggregate" not in plan and plan.count(str(tmp_path)) >= 2


def test_a_hot_key_is_looked_up_in_parts(spark):
    """Without broadcast the rows of a hot key go to several tasks, and the result is the same."""
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    usual = keys.repeats_per_key(rows, ["k"])
    former = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        apart = keys.repeats_per_key(rows, ["k"])
        assert "_part" in plan_of(apart)
        assert same_rows(usual, apart) and apart.count() == usual.count() > 1300
    finally:
        for name, value in former.items():
            spark.conf.set(name, value)
