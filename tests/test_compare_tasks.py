"""Rows of differing partitions are dealt out by their number, unless one row has many copies."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from contract.registry import QUERIES
from strata.operators import compare

SF = "/root/testdata/sf0.001"


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def versions(spark, n=3000):
    rows = spark.range(n).select(
        (F.col("id") % 7).alias("day"), "id", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") / 3).alias("v"))
    signed = rows.withColumn("v", F.when(F.col("id") == 0, -0.0).when(F.col("id") == 1, float("nan")).otherwise(F.col("v")))
    other = signed.withColumn("v", F.when(F.col("id") == 0, 0.0).when(F.col("id") == 500, 1.0).otherwise(F.col("v")))
    return signed, other.filter("id <> 77").unionByName(rows.filter("id = 9"))


def found(df):
    return sorted(map(str, df.collect()))


def test_tasks_follow_the_rows(spark, monkeypatch):
    left, right = versions(spark)
    monkeypatch.setattr(compare, "ROWS_PER_TASK", 50)
    dealt = compare.differences_by_partition(left, right, ["day"])
    plan = first_plan(dealt)
    rows = sum(p["left_rows"] + p["right_rows"] for p in compare.differing_partitions(left, right, ["day"]).collect())
    assert rows > 1500 and f"{-(-rows // 50)}), REPARTITION_BY_NUM" in plan
    assert found(dealt) == found(compare.differences(left, right)) and dealt.count() == 4


def test_nothing_is_combined_before_the_shuffle(spark):
    plan = first_plan(QUERIES["rows_that_differ_in_two_versions"](spark, SF))
    assert "Aggregate" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_a_row_of_many_copies_is_combined_first(spark, monkeypatch):
    left = versions(spark)[0].unionByName(spark.range(4000).selectExpr("3L AS day", "-1L AS id", "0.5D AS v"))
    right = versions(spark)[1].unionByName(spark.range(3997).selectExpr("3L AS day", "-1L AS id", "0.5D AS v"))
    monkeypatch.setattr(compare, "ROWS_PER_TASK", 500)
    out = compare.differences_by_partition(left, right, ["day"])
    assert "REPARTITION_BY_NUM" not in first_plan(out)
    assert found(out) == found(compare.differences(left, right)) and out.filter("id = -1").first()["_surplus"] == 3


def test_equal_and_empty_frames(spark):
    left = versions(spark)[0]
    for one, other in ((left, left), (left.filter("false"), left.filter("false"))):
        assert compare.differences_by_partition(one, other, ["day"]).isEmpty()
    assert compare.differences_by_partition(left, left.filter("false"), ["day"]).count() == 3000
