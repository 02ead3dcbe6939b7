"""CSV files whose headers differ, and a run log that tells the truth."""

from __future__ import annotations

import os

import pytest
import raw_lake
from strata.lake import Lake
from strata.plans import gold, runs
from strata.plans.bronze import ingest_dataset
from strata.sources.files import read_csv
from strata.sources.tables import read_table, write_table
from strata.streaming.ingest import ingest_stream

OLD = (["year", "month", "day", "hour", "temp", "wspd"], [[2024, 1, 1, 5, 5.0, 10.0]])
NEW = (["year", "month", "day", "hour", "humidity", "temp", "wspd"], [[2024, 1, 1, 6, 77.0, 6.0, 11.0]])


def write_updates(folder):
    raw_lake.write_csv(f"{folder}/a b.csv", *OLD)
    raw_lake.write_csv(f"{folder}/b.csv", *NEW)


def values(df):
    return {r["hour"]: (r["humidity"], r["temp"], r["wspd"]) for r in df.collect()}


EXPECTED = {5: (None, 5.0, 10.0), 6: (77.0, 6.0, 11.0)}


def numbers(df):
    return {int(h): tuple(None if x is None else float(x) for x in row) for h, row in values(df).items()}


def test_files_are_matched_by_column_name(spark, tmp_path):
    write_updates(tmp_path)
    assert numbers(read_csv(spark, str(tmp_path))) == EXPECTED
    assert numbers(read_csv(spark, [str(tmp_path / "a b.csv"), str(tmp_path / "b.csv")])) == EXPECTED


def test_one_header_is_one_scan(spark, tmp_path):
    for name in ("a", "b"):
        raw_lake.write_csv(f"{tmp_path}/{name}.csv", *OLD)
    plan = read_csv(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_mixed_updates_reach_bronze_unshifted(spark, tmp_path, mode):
    lake = Lake(str(tmp_path))
    base = (OLD[0], [[2024, 1, 1, 4, 4.0, 9.0]])
    raw_lake.write_csv(lake.raw("weather/weather.csv"), *base)
    if mode == "incremental":
        ingest_dataset(spark, lake, "weather", mode="full")
    write_updates(lake.raw(update_folder()))
    ingest_dataset(spark, lake, "weather", mode=mode)
    stored = read_table(spark, lake.bronze("weather"))
    assert numbers(stored) == EXPECTED | {4: (None, 4.0, 9.0)}


def update_folder() -> str:
    from strata.config import load_dataset

    return load_dataset("weather").update_path


def test_an_empty_update_folder_is_no_update(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw_lake.write_csv(lake.raw("weather/weather.csv"), *OLD)
    os.makedirs(lake.raw(update_folder()))
    assert ingest_dataset(spark, lake, "weather", mode="full") == 1


def test_stream_and_batch_share_the_register(spark, tmp_path):
    lake = Lake(str(tmp_path))
    folder = lake.raw(update_folder())
    write_updates(folder)
    assert ingest_stream(spark, lake, "weather", folder) == 2
    assert numbers(read_table(spark, lake.bronze("weather"))) == EXPECTED
    assert ingest_dataset(spark, lake, "weather", mode="incremental") == 0


def test_an_interrupted_step_is_a_failure(spark, tmp_path):
    lake = Lake(str(tmp_path))
    path = lake.product("daily_borough_mobility")
    with pytest.raises(KeyboardInterrupt), runs.record_run(spark, lake, "gold", "daily_borough_mobility"):
        raise KeyboardInterrupt
    row = runs.load_runs(spark, lake).first()
    assert (row["status"], row["validation_ok"], row["error_message"]) == ("failed", False, "KeyboardInterrupt")
    write_table(spark.range(1), path)
    with runs.record_run(spark, lake, "gold", gold.INTEGRATED):
        write_table(spark.range(1), lake.gold(gold.INTEGRATED))
    with pytest.raises(SystemExit), runs.record_run(spark, lake, "gold", "daily_borough_mobility"):
        raise SystemExit(3)
    commits = runs.last_commits(spark, lake, {"daily_borough_mobility": path, gold.INTEGRATED: lake.gold(gold.INTEGRATED)})
    assert runs.should_refresh(commits["daily_borough_mobility"], [commits[gold.INTEGRATED]])


def test_appends_side_by_side_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    lake = Lake(str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: runs.append_run(spark, lake, runs.Run("gold", f"d{i}"), 0.1), range(12)))
    assert runs.load_runs(spark, lake).select("dataset").distinct().count() == 12


def test_small_table_helpers(spark, tmp_path):
    from strata.sources.tables import as_view, preview

    path = write_table(spark.range(5), str(tmp_path / "t"))
    as_view(spark, path, "five")
    assert spark.sql("SELECT sum(id) FROM five").first()[0] == 10
    assert preview(read_table(spark, path), 2)[0] == 5


def test_a_slice_of_a_product_is_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "day string, n int")
    gold.write_product(rows, path, ("day",))
    gold.write_product_slice(spark.createDataFrame([("b", 2)], "day string, n int"), path, ("day",))
    assert {(r["day"], r["n"]) for r in read_table(spark, path).collect()} == {("a", 1), ("b", 2)}


def test_commands_run_in_utc(spark, tmp_path, monkeypatch):
    from strata import jobs

    raw_lake.write_csv(Lake(str(tmp_path)).raw("weather/weather.csv"), *OLD)
    jobs.main(["--lake", str(tmp_path), "bronze", "--dataset", "weather", "--mode", "full"])
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    jobs.main(["--lake", str(tmp_path), "report", "--rows", "1"])


def test_summary_over_datasets(spark):
    from strata.operators.rules import run_row_checks, validation_summaries

    rows = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None)], "k int, v double")
    rules = [{"rule": "not_null", "columns": ["v"]}, {"rule": "primary_key", "columns": ["k"]}]
    results = {"a": run_row_checks(rows, rules), "b": run_row_checks(rows.filter("k = 2"), rules)}
    found = {r["dataset"]: (r["kept"], r["rejected"]) for r in validation_summaries(results).collect()}
    assert found == {"a": (1, 2), "b": (0, 1), "total": (1, 3)}
