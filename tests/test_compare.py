"""Equality by fingerprints against equality by rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from strata.operators import compare

ROWS = "day string, k int, v double, tags map<string,int>, xs array<double>"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


BASE = [
    ("a", 1, 0.0, {"x": 1, "y": 2}, [1.0]), ("a", 1, 0.0, {"x": 1, "y": 2}, [1.0]), ("b", 2, None, None, None),
    ("b", None, 2.0, {}, []), (None, 3, float("nan"), {"z": None}, [None]), ("c", 4, 1.5, None, [2.0, 1.0]),
]


def parts(left, right):
    return sorted((str(r["day"]), r["left_rows"], r["right_rows"]) for r in compare.differing_partitions(left, right, ["day"]).collect())


def test_equal_whatever_the_order(spark):
    left = frame(spark, BASE).repartition(5)
    right = frame(spark, [("a", 1, -0.0, {"y": 2, "x": 1}, [1.0]), *BASE[1:]]).coalesce(1).select("xs", "tags", "v", "k", "day")
    assert parts(left, right) == []


def test_changed_rows_are_found_in_their_partition(spark):
    left = frame(spark, BASE)
    swapped = [("b", None, 2.0, None, None), ("b", 2, None, {}, []), *BASE[:2], *BASE[4:]]
    assert parts(left, frame(spark, swapped)) == [("b", 2, 2)]
    assert parts(left, frame(spark, BASE[1:])) == [("a", 2, 1)]
    assert parts(left, frame(spark, BASE[:5])) == [("c", 1, 0)]
    assert parts(left, frame(spark, [*BASE, (None, 9, 1.0, None, None)])) == [("None", 1, 2)]
    assert parts(left.filter("false"), left.filter("false")) == []
    doubled = frame(spark, [BASE[0]] * 3 + BASE[2:])
    assert parts(left, doubled) == [("a", 2, 3)]


def test_drilling_down_finds_the_rows(spark):
    lines = spark.range(2000).select((F.col("id") % 50).alias("day"), "id", (F.col("id") * 2).alias("v"))
    other = lines.withColumn("v", F.when(F.col("id").isin(7, 1999), F.col("v") + 1).otherwise(F.col("v"))).filter("id <> 100")
    found = sorted(tuple(r) for r in compare.differences_by_partition(lines, other, ["day"]).collect())
    assert found == sorted(tuple(r) for r in compare.differences(lines, other).collect()) and len(found) == 5
    assert {r["day"] for r in compare.differing_partitions(lines, other, ["day"]).collect()} == {7, 49, 0}


def test_equal_frames_shuffle_no_rows(spark):
    lines = spark.range(100_000).select((F.col("id") % 10).alias("day"), "id")
    plan = compare.fingerprints(lines, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("partial_sum")
