"""Refreshing what has changed, and a run log that stays small."""

from __future__ import annotations

import os
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import raw_lake
from pyspark.sql import functions as F
from strata.lake import Lake
from strata.operators.compare import same_rows
from strata.plans import gold, runs, silver
from strata.plans.bronze import ingest_all
from strata.sources.tables import current_path, read_table, write_table

BOOKKEEPING = ("_data_source", "_created_at", "_refreshed_at", "_schema_version")


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw_lake.build(spark, lake)
    ingest_all(spark, lake)
    silver.promote_all(spark, lake)
    gold.integrate(spark, lake)
    gold.build_products(spark, lake)
    return lake


def partition_files(spark, path):
    """Partition directory -> its files and their times."""
    root, out = current_path(spark, path), {}
    for folder, _, names in os.walk(root):
        kept = [n for n in names if n.endswith(".parquet")]
        if kept:
            out[os.path.relpath(folder, root)] = sorted((n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in kept)
    return out


def changed(before, after):
    return sorted(k for k in after if before.get(k) != after[k])


def add_trips(spark, lake, day):
    """Trips of an existing day once more, on another day."""
    trips = read_table(spark, lake.silver("taxi_trips"))
    some = trips.filter("pickup_date = DATE'2024-01-11'").withColumn("pickup_date", F.lit(day).cast("date"))
    shift = F.datediff(F.col("pickup_date"), F.lit("2024-01-11").cast("date"))
    for c in ("pickup_datetime", "dropoff_datetime"):
        some = some.withColumn(c, F.col(c) + F.make_dt_interval(shift))
    write_table(some, lake.silver("taxi_trips"), ["pickup_date"], mode="append")
    return some.count()


def whole_again(spark, lake, product):
    integrated = read_table(spark, lake.gold(gold.INTEGRATED))
    return product.build(integrated)


def test_one_new_day_rewrites_one_day_and_one_month(spark, lake):
    rows = read_table(spark, lake.gold(gold.INTEGRATED)).count()
    assert gold.integrate_changes(spark, lake) == [] and gold.refresh_changes(spark, lake) == {}
    tables = {"integrated": lake.gold(gold.INTEGRATED), **{p.name: lake.product(p.name) for p in gold.PRODUCTS[:2]}}
    before = {name: partition_files(spark, path) for name, path in tables.items()}
    created = read_table(spark, tables["daily_borough_mobility"]).agg(F.min("_created_at")).first()[0]
    n = add_trips(spark, lake, "2024-02-20")
    assert gold.integrate_changes(spark, lake) == ["2024-02-20"]
    done = gold.refresh_changes(spark, lake)
    assert done["daily_borough_mobility"] == ["2024-02-20"] and done["taxi_zone_monthly_demand"] == ["2024-02-01"]
    assert [name for name, values in done.items() if values is None] == [p.name for p in gold.PRODUCTS[2:]]
    after = {name: partition_files(spark, path) for name, path in tables.items()}
    assert changed(before["integrated"], after["integrated"]) == ["pickup_date=2024-02-20"]
    assert changed(before["daily_borough_mobility"], after["daily_borough_mobility"]) == ["pickup_date=2024-02-20"]
    assert changed(before["taxi_zone_monthly_demand"], after["taxi_zone_monthly_demand"]) == ["trip_month=2024-02-01"]
    by_date = read_table(spark, tables["integrated"])
    assert by_date.count() == rows + n and same_rows(by_date, read_table(spark, lake.gold(gold.INTEGRATED_BY_BOROUGH)))
    for product in gold.PRODUCTS[:2]:
        stored = read_table(spark, lake.product(product.name))
        assert same_rows(stored.drop(*BOOKKEEPING), whole_again(spark, lake, product)), product.name
    assert read_table(spark, tables["daily_borough_mobility"]).agg(F.max("_created_at")).first()[0] == created
    incremental = by_date.drop("_ingested_at")
    rewritten = Lake(lake.root)
    kept = incremental.collect()
    gold.integrate(spark, rewritten)
    assert sorted(map(str, kept)) == sorted(map(str, read_table(spark, tables["integrated"]).drop("_ingested_at").collect()))


def test_weather_of_a_day_and_more_trips_of_a_day(spark, lake):
    weather = read_table(spark, lake.silver("weather")).filter("observation_date = DATE'2024-01-12'")
    write_table(weather.withColumn("temperature_c", F.col("temperature_c") + 50), lake.silver("weather"), ["observation_date"], dynamic=True)
    add_trips(spark, lake, "2024-01-10")
    assert gold.integrate_changes(spark, lake, write_borough_layout=False) == ["2024-01-10", "2024-01-12"]
    assert gold.integrate_changes(spark, lake) == []
    warm = read_table(spark, lake.gold(gold.INTEGRATED)).groupBy("pickup_date").agg(F.min("temperature_c")).collect()
    assert {str(r[0]): r[1] > 40 for r in warm if r[1] is not None}["2024-01-12"]
    kept = read_table(spark, lake.gold(gold.INTEGRATED)).collect()
    gold.integrate(spark, lake, write_borough_layout=False)
    assert sorted(map(str, kept)) == sorted(map(str, read_table(spark, lake.gold(gold.INTEGRATED)).collect()))


def test_new_zones_rewrite_everything(spark, lake):
    zones = read_table(spark, lake.silver("taxi_zones")).withColumn("zone", F.lit("Elsewhere"))
    write_table(zones.coalesce(1), lake.silver("taxi_zones"))
    assert len(gold.integrate_changes(spark, lake, write_borough_layout=False)) > 2
    found = read_table(spark, lake.gold(gold.INTEGRATED)).filter("pickup_zone = 'Elsewhere'").count()
    assert found == raw_lake.GOOD_TRIPS


def test_integration_waits_for_newer_silver(spark, lake):
    def steps():
        return runs.load_runs(spark, lake).filter((F.col("layer") == "gold") & (F.col("dataset") == gold.INTEGRATED)).count()

    before = steps()
    gold.integrate(spark, lake, force=False)
    assert steps() == before
    silver.promote_dataset(spark, lake, "weather")
    gold.integrate(spark, lake, force=False, write_borough_layout=False)
    assert steps() == before + 1
    assert runs.last_commit(spark, lake, "weather", lake.silver("weather"), "silver") > datetime(2024, 1, 1)


def many_runs(lake, n):
    """Rows as the log writes them, one directory each."""
    now, names = datetime.now(timezone.utc), [f.name for f in runs.RUN_SCHEMA.fields if f.name != "layer"]
    for i in range(n):
        folder = f"{lake.pipeline_runs}/layer={('bronze', 'silver', 'gold')[i % 3]}/r{i}"
        os.makedirs(folder)
        row = {"run_id": f"r{i}", "dataset": f"d{i % 7}", "started_at": now, "finished_at": now, "duration_seconds": 1.0, "schema_version": "1.0",
               "status": "success", "validation_ok": True, "error_message": None}
        columns = {k: [row.get(k)] for k in names}
        types = {"started_at": pa.timestamp("us", "UTC"), "finished_at": pa.timestamp("us", "UTC"), "validation_ok": pa.bool_(), "duration_seconds": pa.float64()}
        arrays = [pa.array(v, types.get(k, pa.int64() if k.endswith(("records", "failures")) else pa.string())) for k, v in columns.items()]
        pq.write_table(pa.table(dict(zip(names, arrays, strict=True))), f"{folder}/part-0.parquet")


def files_of(lake):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(lake.pipeline_runs) for n in names)


def test_a_thousand_steps_are_a_few_files(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    many_runs(lake, 1000)
    assert files_of(lake) == 1000 and runs.load_runs(spark, lake).count() == 1000
    assert set(runs.fold_runs(spark, lake)) == {"bronze", "silver", "gold"} and files_of(lake) <= 3 * 8
    assert runs.load_runs(spark, lake).groupBy("layer").count().count() == 3 and runs.load_runs(spark, lake).count() == 1000
    with runs.record_run(spark, lake, "gold", "x") as run:
        run.loaded(1)
    assert runs.load_runs(spark, lake).count() == 1001 and runs.fold_runs(spark, lake) == {}
    plan = runs.load_runs(spark, lake).filter("layer = 'gold'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer" in plan


def test_an_interrupted_folding_counts_no_run_twice(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    many_runs(lake, 30)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(runs, "remove_table", killed)
        with pytest.raises(KeyboardInterrupt):
            runs.fold_runs(spark, lake, 3)
    assert runs.load_runs(spark, lake).count() == 30
    runs.fold_runs(spark, lake, 3)
    assert runs.load_runs(spark, lake).count() == 30 and files_of(lake) < 30
