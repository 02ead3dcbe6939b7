"""The streaming front end of the ingest."""

from __future__ import annotations

import raw_lake
from strata.lake import Lake
from strata.sources.tables import read_table
from strata.streaming.ingest import ingest_stream

HEADER = ["year", "month", "day", "hour", "temp", "wspd", "rhum"]


def test_each_file_is_loaded_once(spark, tmp_path):
    lake = Lake(str(tmp_path))
    source = lake.raw("arriving")
    raw_lake.write_csv(source + "/a.csv", HEADER, raw_lake.weather_rows(10))
    raw_lake.write_csv(source + "/b.csv", HEADER, raw_lake.weather_rows(5))
    assert ingest_stream(spark, lake, "weather", source, files_per_batch=1) == 15
    assert ingest_stream(spark, lake, "weather", source) == 0
    raw_lake.write_csv(source + "/c.csv", HEADER, raw_lake.weather_rows(3))
    assert ingest_stream(spark, lake, "weather", source) == 3
    bronze = read_table(spark, lake.bronze("weather"))
    assert bronze.count() == 18 and dict(bronze.dtypes)["temp"] == "double"
    assert not [c for c in bronze.columns if c.startswith("_file")]


def test_a_fresh_stream_respects_the_register(spark, tmp_path):
    """A lost checkpoint must not load registered files again."""
    lake = Lake(str(tmp_path))
    source = lake.raw("arriving")
    raw_lake.write_csv(source + "/a.csv", HEADER, raw_lake.weather_rows(4))
    assert ingest_stream(spark, lake, "weather", source) == 4

    class Elsewhere(Lake):
        def staging(self, name):
            return self._join("ops", "other", name)

    assert ingest_stream(spark, Elsewhere(lake.root), "weather", source) == 0
    assert read_table(spark, lake.bronze("weather")).count() == 4
