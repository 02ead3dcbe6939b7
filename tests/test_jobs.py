"""The whole lake, from raw files to products, on a small raw area."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import raw_lake
from strata.config import list_datasets, load_dataset
from strata.lake import Lake
from strata.operators.compare import same_rows
from strata.plans import analytics, evaluation, gold, raw_training, reports, runs, silver, training, updates
from strata.plans.bronze import ingest_all, ingest_dataset
from strata.sources import files, tables


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    raw_lake.build(spark, lake)
    ingest_all(spark, lake)
    silver.promote_all(spark, lake)
    gold.integrate(spark, lake)
    return lake


def read(spark, path):
    return tables.read_table(spark, path)


def run_rows(spark, lake, dataset, layer):
    df = runs.load_runs(spark, lake).filter((F.col("dataset") == dataset) & (F.col("layer") == layer))
    return df.orderBy("started_at").collect()


def test_configuration():
    assert list_datasets() == ["air_quality", "taxi_trips", "taxi_zones", "weather"]
    cfg = load_dataset("weather")
    assert cfg.expected["temp"] == "double" and not cfg.infer_schema
    with pytest.raises(FileNotFoundError):
        load_dataset("nothing")


def test_bronze(spark, lake):
    trips = read(spark, lake.bronze("taxi_trips"))
    assert trips.count() == raw_lake.GOOD_TRIPS + 9
    assert {"taxi_type", "pickup_date", "_ingested_at", "pickup_datetime"} <= set(trips.columns)
    air = read(spark, lake.bronze("air_quality"))
    assert air.count() == 3 * raw_lake.HOURS and "County_Code" in air.columns
    assert run_rows(spark, lake, "taxi_trips", "bronze")[0]["inserted_records"] == raw_lake.GOOD_TRIPS + 9


def test_silver_and_rejects(spark, lake):
    kept = read(spark, lake.silver("taxi_trips"))
    rejected = read(spark, lake.rejects("taxi_trips"))
    assert (kept.count(), rejected.count()) == (raw_lake.GOOD_TRIPS, 9)
    reasons = {r["_reject_reason"]: r["count"] for r in rejected.groupBy("_reject_reason").count().collect()}
    assert reasons == {
        "range:fare_amount": 1, "range:fare_amount,range:trip_distance": 1, "null:dropoff_datetime": 1,
        "ts_order:pickup_datetime>dropoff_datetime": 1, "ts_range:pickup_datetime": 2, "duplicate_pk": 3,
    }
    assert "_rejected_at" in rejected.columns
    log = run_rows(spark, lake, "taxi_trips", "silver")[0]
    assert (log["processed_records"], log["rejected_records"], log["validation_ok"]) == (409, 9, False)
    assert read(spark, lake.silver("weather")).count() == raw_lake.HOURS
    assert read(spark, lake.rejects("weather")).first()["_reject_reason"] == "null:obs_timestamp"
    zones = read(spark, lake.silver("taxi_zones"))
    assert sorted(zones.select("location_id", "borough").collect()) == [(1, "Queens"), (2, "Manhattan"), (3, "Bronx")]


def test_gold_layouts(spark, lake):
    by_date = read(spark, lake.gold("integrated_taxi_trips"))
    assert by_date.count() == raw_lake.GOOD_TRIPS
    by_borough = read(spark, lake.gold("integrated_taxi_trips_by_borough"))
    assert same_rows(by_date, by_borough)
    assert by_date.filter(F.col("dropoff_zone") == "UNKNOWN").count() == raw_lake.GOOD_TRIPS // 4
    pruned = evaluation.on_day(by_date, "2024-01-11")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert same_rows(pruned, evaluation.on_day(by_date, "2024-01-11", partition_column=None))
    report = {r["table"]: r for r in evaluation.storage_report(spark, {
        "date": lake.gold("integrated_taxi_trips"), "borough": lake.gold("integrated_taxi_trips_by_borough"),
        "none": lake.gold("nothing")}).collect()}
    assert set(report) == {"date", "borough"}
    assert report["date"]["partitions"] == by_date.select("pickup_date").distinct().count()
    assert report["borough"]["bytes"] > 0


def test_products_refresh_only_when_stale(spark, lake):
    written = gold.build_products(spark, lake)
    assert set(written) == {p.name for p in gold.PRODUCTS}
    assert gold.build_products(spark, lake) == {}
    integrated = read(spark, lake.gold("integrated_taxi_trips"))
    stored = read(spark, lake.product("daily_borough_mobility"))
    assert same_rows(stored.drop("_data_source", "_created_at", "_refreshed_at", "_schema_version"),
                     analytics.daily_borough_mobility(integrated))
    created = stored.agg(F.min("_created_at")).first()[0]
    gold.build_products(spark, lake, force=True, products=gold.PRODUCTS[:1])
    again = read(spark, lake.product("daily_borough_mobility"))
    first = again.agg(F.min("_created_at"), F.min("_refreshed_at"), F.min("_schema_version")).first()
    assert first[0] == created and first[1] > created and first[2] == "1.0"
    gold.integrate(spark, lake, write_borough_layout=False)
    assert {p.name for p in gold.stale_products(spark, lake)} == {p.name for p in gold.PRODUCTS}


def test_staleness_rule(spark, lake):
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 2)
    assert runs.should_refresh(datetime.min, [low])
    assert runs.should_refresh(low, [high]) and not runs.should_refresh(high, [high, low])
    assert runs.last_commit(spark, lake, "absent", lake.gold("absent")) == datetime.min
    assert runs.last_commit(spark, lake, "no log", lake.silver("weather")) > datetime(2020, 1, 1)


def test_dynamic_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).select("id", (F.col("id") % 3).alias("p"))
    tables.write_table(df, path, ["p", "absent"])
    tables.write_table(df.filter("p = 1").withColumn("id", F.lit(100)), path, ["p"], dynamic=True)
    assert sorted(r["id"] for r in read(spark, path).collect()) == [0, 2, 3, 5, 100, 100]


def test_noted_schema_follows_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(2).select("id", F.lit("7").alias("p")), path, ["p"])
    assert read(spark, path).dtypes == [("id", "bigint"), ("p", "string")]
    tables.write_table(spark.range(2, 4).select("id", F.lit("x").alias("note"), F.lit("8").alias("p")), path, ["p"], mode="append")
    assert read(spark, path).columns == ["id", "note", "p"] and read(spark, path).count() == 4
    merged = tables.read_table(spark, path, merge_schema=True)
    assert same_rows(read(spark, path), merged.withColumn("p", F.col("p").cast("string")))
    tables.write_table(spark.range(1), path)
    assert read(spark, path).columns == ["id"]
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert read(spark, str(tmp_path / "plain")).count() == 3


def test_schema_failure_is_logged(spark, lake, tmp_path):
    other = Lake(str(tmp_path))
    raw_lake.write_csv(other.raw("weather/weather.csv"), ["year", "month"], [(2024, 1)])
    with pytest.raises(ValueError, match="Schema validation failed"):
        ingest_dataset(spark, other, "weather")
    row = run_rows(spark, other, "weather", "bronze")[0]
    assert (row["status"], row["validation_ok"], row["validation_failures"]) == ("failed", False, 4)
    assert "missing column: day" in row["error_message"]


def test_run_log_keeps_the_error(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(RuntimeError):
        with runs.record_run(spark, lake, "gold", "x"):
            raise RuntimeError("e" * 3000)
    rows = runs.load_runs(spark, lake).collect()
    assert len(rows) == 1 and len(rows[0]["error_message"]) == 2000
    with runs.record_run(spark, Lake("/proc/none"), "gold", "x") as run:
        run.loaded(1)


def test_incremental_cycle(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw_lake.build(spark, lake)
    ingest_all(spark, lake)
    silver.promote_all(spark, lake)
    before = read(spark, lake.silver("weather")).count()
    made = {r.dataset: r for r in updates.run_all_generators(spark, lake)}
    assert 0 < made["taxi_trips"].new_rows < 0.15 * raw_lake.GOOD_TRIPS and made["taxi_trips"].duplicates > 0
    assert made["weather"].new_rows == raw_lake.HOURS
    assert made["weather"].period_start == datetime(2024, 1, 10) + timedelta(hours=89)
    # 87 hours reach further back than the 72 in the file; of four sites three are in the state.
    assert made["air_quality"].new_rows == 3 * raw_lake.HOURS

    first = ingest_all(spark, lake, ["taxi_trips", "weather", "air_quality"])
    assert first["weather"] == raw_lake.HOURS and first["taxi_trips"] > 0
    rows = read(spark, lake.bronze("weather")).count()
    assert ingest_all(spark, lake, ["taxi_trips", "weather", "air_quality"]) == dict.fromkeys(first, 0)
    assert read(spark, lake.bronze("weather")).count() == rows

    silver.promote_all(spark, lake)
    weather = read(spark, lake.silver("weather"))
    assert weather.count() == before + raw_lake.HOURS and weather.filter("humidity IS NULL").count() == before
    integrated = gold.integrate(spark, lake)
    assert {"humidity", "aqi"} <= set(integrated.columns)
    gold.build_products(spark, lake)
    impact = read(spark, lake.product("weather_impact_summary"))
    assert "avg_humidity_pct" in impact.columns and impact.first()["_schema_version"] == "1.1"
    assert "avg_aqi_index" in read(spark, lake.product("air_quality_demand_summary")).columns

    kept = read(spark, lake.silver("air_quality")).count()
    ingest_all(spark, lake, ["air_quality"], mode="full")
    silver.promote_all(spark, lake, ["air_quality"])
    assert read(spark, lake.silver("air_quality")).count() == kept


def test_missing_update_is_an_error(spark, lake):
    with pytest.raises(FileNotFoundError, match="has no update data"):
        ingest_dataset(spark, lake, "weather", mode="incremental")


def test_merge_to_silver(spark, tmp_path):
    lake = Lake(str(tmp_path))
    base = spark.createDataFrame([(1, 1.0, "d1"), (2, 2.0, "d1")], "k int, v double, day string")
    silver.promote_frame(base, lake, "t", ["k"], ["day"])
    update = spark.createDataFrame(
        [(2, "9", "d1", 7), (3, "3", "d2", 7), (3, "3", "d2", 7), (4, None, "d2", 7)], "k int, v string, day string, extra int")
    assert silver.merge_to_silver(update, lake, "t", ["k"], ["day"], not_null=["v"]) == (1, 1)
    assert silver.merge_to_silver(update, lake, "t", ["k"], ["day"], not_null=["v"]) == (0, 1)
    rows = sorted(read(spark, lake.silver("t")).select("k", "v", "day", "extra").collect())
    assert rows == [(1, 1.0, "d1", None), (2, 2.0, "d1", None), (3, 3.0, "d2", 7)]
    assert read(spark, lake.rejects("t")).count() == 2


def test_merging_updates_equals_promoting_them(spark, tmp_path):
    """Upserting the update and recomputing silver from bronze lead to the same keys."""
    merged, recomputed = Lake(str(tmp_path / "a")), Lake(str(tmp_path / "b"))
    for lake in (merged, recomputed):
        raw_lake.build(spark, lake)
        ingest_all(spark, lake)
        silver.promote_all(spark, lake)
        updates.run_all_generators(spark, lake)
    for name in ("taxi_trips", "weather", "air_quality"):
        inserted, rejected = silver.merge_dataset_update(spark, merged, name)
        # New trips follow a stray pickup in June, outside the accepted period, and the copies are known already.
        assert (inserted > 0) == (name != "taxi_trips") and (rejected > 0) == (name == "taxi_trips")
        assert silver.merge_dataset_update(spark, merged, name)[0] == 0
    ingest_all(spark, recomputed)
    silver.promote_all(spark, recomputed)
    for name in ("taxi_trips", "weather", "air_quality"):
        key = list(load_dataset(name).silver.primary_key)
        left, right = (read(spark, where.silver(name)).select(*key) for where in (merged, recomputed))
        assert same_rows(left, right), name
    assert "humidity" in read(spark, merged.silver("weather")).columns


def test_reports(spark, lake):
    made = reports.monitoring_report(spark, lake)
    assert set(made) == set(reports.REPORTS)
    assert made["execution_time_by_layer"].count() == 3
    families = {r["dataset"] for r in made["rejects_per_execution"].collect()}
    assert families == {"taxi_trips", "weather", "air_quality", "taxi_zones"}
    assert spark.sql("SELECT count(*) FROM pipeline_runs_by_source").first()[0] == runs.load_runs(spark, lake).count()


def test_mixed_files(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, 2.5)], "id int, x double").coalesce(1).write.parquet(root + "/yellow/a")
    raw_lake.write_csv(root + "/green/b.csv", ["id", "y"], [(2, "text")])
    raw_lake.write_csv(root + "/green/c.CSV", ["id", "x"], [(3, "bad")])
    found = files.discover_files(spark, root, ("YELLOW", "green"))
    assert len(found) == 3
    df = files.read_mixed(spark, found)
    assert dict(df.dtypes) == {"id": "int", "x": "double", "y": "string"}
    assert sorted(df.select("id", "x", "y").collect()) == [(1, 2.5, None), (2, None, "text"), (3, None, None)]
    with pytest.raises(FileNotFoundError):
        files.discover_files(spark, root, ("purple",))


def test_training_from_raw_and_from_the_lake(spark, lake, tmp_path):
    parts = raw_training.raw_training_splits(spark, lake.raw())
    # One stray pickup in June passes here; only the lake rejects it.
    assert [p.count() for p in parts[1:]] == [0, 1]
    train = parts[0]
    # The raw path keeps rows that the lake rejects, such as the repeated ones; only unusable fares are dropped.
    assert train.count() > raw_lake.GOOD_TRIPS
    assert train.filter("pm25 = 0").count() < train.count()
    integrated = read(spark, lake.gold("integrated_taxi_trips"))
    small = {"iterations": 2, "depth": 2}
    model = training.train(integrated, fraction=1.0, **small)
    path = training.save_model(model, str(tmp_path / "m"))
    ours = training.predict(model, integrated).select("pickup_datetime", "prediction")
    assert same_rows(ours, training.predict(path, integrated).select("pickup_datetime", "prediction"))
    results = training.compare_inputs({"raw": (train, train), "lake": (integrated, integrated)}, fraction=1.0, **small)
    assert set(results) == {"raw", "lake"}
    row = training.regression_metrics(training.predict(model, integrated)).first()
    check = training.evaluate(model, integrated)
    assert row["rmse"] == pytest.approx(check.rmse, abs=1e-3) and row["r2"] == pytest.approx(check.r2, abs=1e-3)
    assert check.by_borough.agg(F.sum("trip_count")).first()[0] == integrated.count()


def test_measurements(spark, lake, tmp_path):
    integrated = read(spark, lake.gold("integrated_taxi_trips"))
    once = analytics.trips_per_borough(integrated)
    assert evaluation.compare_frames("q", once, once, lake.gold("integrated_taxi_trips")).storage_bytes > 0
    with pytest.raises(AssertionError):
        evaluation.compare_frames("q", once, once.limit(1))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    assert evaluation.compare_adaptive(spark, "q", lambda: analytics.peak_hours_by_weekday(integrated)).same_result
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    seconds = evaluation.reuse_experiment(integrated, [analytics.trips_per_borough, analytics.average_fare_per_borough])
    assert min(seconds) > 0
    assert evaluation.logging_overhead(spark, Lake(str(tmp_path)), 1)["per_append"] > 0


def test_readiness(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw_lake.build(spark, lake)
    ingest_all(spark, lake)
    silver.promote_all(spark, lake)
    report = evaluation.readiness(spark, lake, samples=1)
    rows = {(r["section"], r["name"]): r["value"] for r in report.collect()}
    assert {("incremental", "silver"), ("refresh", "products"), ("storage_mb", "growth")} <= set(rows)
    compared = evaluation.compare_ingest(spark, lake)
    assert compared.count() == 3
