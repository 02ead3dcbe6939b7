"""Files of any name, loads that happen once, overwrites that happen at once, and lines that do not fit their header."""

from __future__ import annotations

import os
import threading

import pytest
import raw_lake
from pyspark.sql import functions as F
from strata.config import load_dataset
from strata.lake import Lake
from strata.plans import bronze, silver
from strata.plans.bronze import ingest_dataset
from strata.sources import files, tables
from strata.sources.tables import read_table, write_table
from strata.streaming.ingest import ingest_stream

HEADER = ["year", "month", "day", "hour", "temp", "wspd"]
MORE = ["year", "month", "day", "hour", "humidity", "temp", "wspd"]
#: Each of them, taken as a pattern, would miss itself or fit another one.
NAMES = ["u[1].csv", "u1.csv", "{a,b}.csv", "a.csv", "b.csv", "x*.csv", "xy.csv", "q?.csv", "p%20q.csv", "p q.csv", "back\\slash.csv", "h#ash&=+.csv", "é漢.csv"]
CFG = load_dataset("weather")


def row(hour, header=HEADER):
    return [{"hour": hour, "humidity": 70.0 + hour}.get(c, 2024 if c == "year" else 1 if c in ("month", "day") else float(hour)) for c in header]


def write_odd_names(folder, mixed=True):
    for hour, name in enumerate(NAMES):
        header = MORE if mixed and hour % 2 else HEADER
        raw_lake.write_csv(f"{folder}/{name}", header, [row(hour, header)])


def base(lake):
    raw_lake.write_csv(lake.raw("weather/weather.csv"), HEADER, [row(20)])


def stored(spark, lake):
    """hour -> (humidity, temp, wspd) of bronze, one row per hour."""
    rows = read_table(spark, lake.bronze("weather")).collect()
    out = {int(r["hour"]): tuple(None if r[c] is None else float(r[c]) for c in ("humidity", "temp", "wspd") if c in r) for r in rows}
    assert len(out) == len(rows)
    return out


def expected(hours, extra=()):
    return {h: (70.0 + h if h % 2 else None, float(h), float(h)) for h in hours} | {h: (None, float(h), float(h)) for h in extra}


# --- names ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["full", "incremental", "stream"])
def test_names_are_no_patterns(spark, tmp_path, how):
    lake = Lake(str(tmp_path / "lake[0-9]"))
    base(lake)
    folder = lake.raw(CFG.update_path)
    if how != "full":
        ingest_dataset(spark, lake, "weather", mode="full")
    write_odd_names(folder)
    if how == "stream":
        assert ingest_stream(spark, lake, "weather", folder, files_per_batch=5) == len(NAMES)
    else:
        ingest_dataset(spark, lake, "weather", mode=how)
    assert stored(spark, lake) == expected(range(len(NAMES)), [20])
    known = bronze.registered_files(spark, lake, CFG).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in known) == sorted(NAMES)
    assert ingest_dataset(spark, lake, "weather", mode="incremental") == 0


def test_mixed_files_of_odd_names(spark, tmp_path):
    write_odd_names(tmp_path / "rain{1}")
    spark.createDataFrame([(50, 5.0)], "hour int, temp double").coalesce(1).write.parquet(str(tmp_path / "made"))
    part = next(n for n in os.listdir(tmp_path / "made") if n.endswith(".parquet"))
    os.makedirs(tmp_path / "rain{2}")
    os.rename(tmp_path / "made" / part, tmp_path / "rain{2}" / "p[q].parquet")
    found = files.discover_files(spark, str(tmp_path), ["RAIN"])
    assert len(found) == len(NAMES) + 1
    rows = {r["hour"]: r["humidity"] for r in files.read_mixed(spark, found).collect()}
    assert rows == {h: str(70.0 + h) if h % 2 else None for h in range(len(NAMES))} | {50: None}


def test_headers_cost_a_buffer_per_file(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.csv").write_text("\n \nk,v\n" + "1,2\n" * 500_000)
    (tmp_path / "empty.csv").write_text("")
    before = bytes_read(spark)
    assert files.header_groups(spark, [str(tmp_path)]) == [[str(tmp_path)]]
    assert bytes_read(spark) - before < 4 * 2**18
    (tmp_path / "b.csv").write_text("v,k\n2,1\n")
    assert sorted(map(len, files.header_groups(spark, [str(tmp_path)]))) == [1, 2]
    assert files.read_csv(spark, str(tmp_path)).filter("k = '1' AND v = '2'").count() == 1_000_001


def bytes_read(spark):
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    return statistics.get("file").getLong("bytesRead") or 0


# --- loads ------------------------------------------------------------------------------------------------------------


def killed(*_, **__):
    raise KeyboardInterrupt


@pytest.mark.parametrize("dies_in", ["finish_load", "write_table"])
@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_a_driver_that_dies_loads_nothing_twice(spark, tmp_path, monkeypatch, dies_in, mode):
    lake = Lake(str(tmp_path))
    base(lake)
    ingest_dataset(spark, lake, "weather", mode="full")
    raw_lake.write_csv(f"{lake.raw(CFG.update_path)}/one.csv", MORE, [row(1, MORE)])
    with monkeypatch.context() as m:
        m.setattr(bronze, dies_in, killed)
        with pytest.raises(KeyboardInterrupt):
            ingest_dataset(spark, lake, "weather", mode=mode)
    raw_lake.write_csv(f"{lake.raw(CFG.update_path)}/three.csv", MORE, [row(3, MORE)])
    ingest_dataset(spark, lake, "weather", mode="incremental")
    assert stored(spark, lake) == expected([1, 3], [20])
    assert ingest_dataset(spark, lake, "weather", mode="incremental") == 0
    assert tables.child_names(spark, f"{lake.load_intents}/weather") == []


def test_a_load_that_was_half_written_is_replaced(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    base(lake)
    ingest_dataset(spark, lake, "weather", mode="full")
    raw_lake.write_csv(f"{lake.raw(CFG.update_path)}/one.csv", MORE, [row(1, MORE), row(5, MORE)])

    def half(df, *args, **kwargs):
        write_table(df.filter("hour = 1"), *args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(bronze, "write_table", half)
        with pytest.raises(KeyboardInterrupt):
            ingest_dataset(spark, lake, "weather", mode="incremental")
    assert set(stored(spark, lake)) == {1, 20}
    assert ingest_dataset(spark, lake, "weather", mode="incremental") == 2
    assert stored(spark, lake) == expected([1, 5], [20])


def test_a_file_that_changed_after_the_crash_is_loaded_as_it_is(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    base(lake)
    ingest_dataset(spark, lake, "weather", mode="full")
    path = f"{lake.raw(CFG.update_path)}/one.csv"
    raw_lake.write_csv(path, MORE, [row(1, MORE)])
    with monkeypatch.context() as m:
        m.setattr(bronze, "finish_load", killed)
        with pytest.raises(KeyboardInterrupt):
            ingest_dataset(spark, lake, "weather", mode="incremental")
    raw_lake.write_csv(path, MORE, [row(3, MORE), row(5, MORE)])
    ingest_dataset(spark, lake, "weather", mode="incremental")
    assert stored(spark, lake) == expected([3, 5], [20])


def test_a_file_that_arrives_during_a_full_load_is_loaded_once(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    base(lake)
    folder = lake.raw(CFG.update_path)
    raw_lake.write_csv(f"{folder}/one.csv", MORE, [row(1, MORE)])
    begin = bronze.begin_load

    def late(*args, **kwargs):
        raw_lake.write_csv(f"{folder}/three.csv", MORE, [row(3, MORE)])
        return begin(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(bronze, "begin_load", late)
        assert ingest_dataset(spark, lake, "weather", mode="full") == 2
    assert ingest_dataset(spark, lake, "weather", mode="incremental") == 1
    assert stored(spark, lake) == expected([1, 3], [20])


def test_a_stream_that_dies_goes_on(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    folder = lake.raw("arriving")
    for hour in (1, 3, 5):
        raw_lake.write_csv(f"{folder}/{hour}.csv", MORE, [row(hour, MORE)])
    with monkeypatch.context() as m:
        m.setattr(bronze, "finish_load", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            ingest_stream(spark, lake, "weather", folder, files_per_batch=1)
    ingest_stream(spark, lake, "weather", folder, files_per_batch=1)
    assert stored(spark, lake) == expected([1, 3, 5])


# --- overwrites -------------------------------------------------------------------------------------------------------


def test_an_open_reader_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    opened = read_table(spark, path)
    write_table(spark.range(100, 103).withColumn("more", F.lit(1)), path)
    assert opened.count() == 5 and sorted(r["id"] for r in opened.collect()) == list(range(5))
    assert read_table(spark, path).columns == ["id", "more"] and read_table(spark, path).count() == 3
    write_table(spark.range(1), path)
    assert len([n for n in os.listdir(path) if n.startswith("v")]) == 2


def test_an_interrupted_overwrite_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with monkeypatch.context() as m:
        m.setattr(tables, "switch_version", killed)
        with pytest.raises(KeyboardInterrupt):
            write_table(spark.range(9), path)
    failing = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(failing, path)
    assert read_table(spark, path).count() == 5
    for _ in range(2):
        write_table(spark.range(7), path)
    assert read_table(spark, path).count() == 7 and len([n for n in os.listdir(path) if n.startswith("v")]) == 2


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    switch, nested = tables.switch_version, []

    def meanwhile(*args):
        if not nested:
            nested.append(True)
            write_table(spark.range(6), path)
        switch(*args)

    with monkeypatch.context() as m:
        m.setattr(tables, "switch_version", meanwhile)
        with pytest.raises(RuntimeError, match="another writer"):
            write_table(spark.range(7), path)
    assert read_table(spark, path).count() == 6


def test_readers_beside_overwrites_see_whole_tables(spark, tmp_path):
    path, seen, over = str(tmp_path / "t"), [], threading.Event()
    write_table(spark.range(10).select(F.lit(0).alias("k")), path)

    def look():
        while not over.is_set():
            seen.append(sorted(tuple(r) for r in read_table(spark, path).groupBy("k").count().collect()))

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(1, 5):
        write_table(spark.range(10).select(F.lit(k).alias("k")), path)
    over.set()
    reader.join()
    assert seen and all(len(s) == 1 and s[0][1] == 10 for s in seen)


def test_a_plain_directory_is_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(path)
    assert tables.table_exists(spark, path) and read_table(spark, path).count() == 3
    write_table(spark.range(2).withColumn("p", F.lit(2)), path, ["p"], mode="append")
    assert read_table(spark, path).count() == 5
    for n in (4, 6):
        write_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    assert not any(name.startswith("p=") for name in os.listdir(path))
    assert not tables.table_exists(spark, str(tmp_path / "none"))


# --- lines that do not fit --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_good_rows_and_malformed_lines_are_all_lines(spark, tmp_path, mode):
    lake = Lake(str(tmp_path))
    base(lake)
    if mode == "incremental":
        ingest_dataset(spark, lake, "weather", mode="full")
    folder = lake.raw(CFG.update_path)
    os.makedirs(folder)
    with open(f"{folder}/m[1].csv", "w") as out:
        out.write(",".join(MORE) + "\n2024,1,1,1,71.0,1.0,1.0\n2024,1,1\n2024,1,1,2,72.0,2.0,2.0,too,many\n2024,1,1,3,73.0,3.0,3.0\n")
    with open(f"{folder}/n.csv", "w") as out:
        out.write(",".join(HEADER) + "\n2024,1,1,6,6.0,6.0\n2024,1,1,7,7.0\n")
    ingest_dataset(spark, lake, "weather", mode=mode)
    assert stored(spark, lake) == expected([1, 3], [6, 20])
    kept = read_table(spark, lake.malformed("weather")).collect()
    assert sorted(r["line"] for r in kept) == ["2024,1,1", "2024,1,1,2,72.0,2.0,2.0,too,many", "2024,1,1,7,7.0"]
    assert {r["_reject_reason"] for r in kept} == {"malformed:fields"}
    assert sorted(r["_source_file"].rsplit("/", 1)[1] for r in kept) == ["m%5B1%5D.csv", "m%5B1%5D.csv", "n.csv"]
    log = bronze_log(spark, lake)[-1]
    assert (log["processed_records"] - log["inserted_records"], log["rejected_records"], log["validation_ok"]) == (3, 3, False)
    silver.promote_dataset(spark, lake, "weather")
    assert read_table(spark, lake.malformed("weather")).count() == 3
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    ingest_dataset(spark, lake, "weather", mode="full")
    assert not tables.table_exists(spark, lake.malformed("weather"))


def bronze_log(spark, lake):
    from strata.plans.runs import load_runs

    return load_runs(spark, lake).filter("layer = 'bronze'").orderBy("started_at").collect()
