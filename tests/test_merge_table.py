"""The upsert into catalog tables, with and without a format that can merge."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from strata.operators import upsert

ROWS = "k int, j string, v double"
HELD = [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 3.0)]
UPDATE = [(2, "b", 9.0), (3, "c", 4.0), (3, "c", 4.0), (None, "n", 8.0), (1, "z", 5.0)]


class Merging:
    """What ``mergeInto`` returns for a format that merges: it matches by the given condition and inserts what is left."""

    def __init__(self, source, table, condition):
        self.source, self.table, self.condition = source, table, condition

    def whenNotMatched(self):  # noqa: N802 - Spark's names
        return self

    def insertAll(self):  # noqa: N802
        return self

    def withSchemaEvolution(self):  # noqa: N802
        return self

    def merge(self):
        spark = self.source.sparkSession
        held = spark.table(self.table)
        rows = self.source.join(held.alias(self.table), self.condition, "left_anti").select(*held.columns).collect()
        spark.createDataFrame(rows, held.schema).write.mode("append").saveAsTable(self.table)


def held_after(spark, name, null_safe):
    spark.createDataFrame(HELD, ROWS).write.saveAsTable(name)
    ways = [upsert.merge_into_table(spark.createDataFrame(UPDATE, ROWS), name, ["k", "j"], null_safe=null_safe) for _ in range(2)]
    rows = sorted(map(str, spark.table(name).collect()))
    spark.sql(f"DROP TABLE {name}")
    return ways, rows


@pytest.mark.parametrize("null_safe", [False, True])
def test_both_ways_leave_the_same_rows(spark, monkeypatch, null_safe):
    ways, appended = held_after(spark, f"upsert_append_{null_safe}", null_safe)
    assert ways == ["append", "append"]
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "mergeInto", lambda df, table, condition: Merging(df, table, condition), raising=False)
        m.setattr(type(spark.range(1)), "mergeInto", lambda df, table, condition: Merging(df, table, condition), raising=False)
        ways, merged = held_after(spark, f"upsert_merge_{null_safe}", null_safe)
    assert ways == ["merge", "merge"] and merged == appended
    # A null in a key matches nothing, as with SQL equality, and comes again with every run.
    assert len(appended) == (5 if null_safe else 7)


def test_other_errors_are_passed_on(spark):
    with pytest.raises(PySparkException, match="cannot be found"):
        upsert.merge_into_table(spark.createDataFrame(UPDATE, ROWS), "upsert_nowhere", ["k", "j"])
