"""Row rules, keys and upserts."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import keys
from strata.operators.rules import (
    quality_rules, reject_counts, require_schema, rule_items, run_row_checks, run_schema_checks, validation_summary,
)
from strata.operators.upsert import rows_to_insert

RULES = [
    {"rule": "not_null", "columns": ["a", "absent"]},
    {"rule": "timestamp_order", "before": "t1", "after": "t2"},
    {"rule": "timestamp_range", "column": "t1", "min": "2024-01-01", "max": "2024-06-01"},
    {"rule": "numeric_range", "column": "fare", "min": 0, "max": 500},
    {"rule": "primary_key", "columns": ["a"]},
]
SCHEMA = "id int, a int, t1 timestamp_ntz, t2 timestamp_ntz, fare double"
T1, T2 = datetime(2024, 2, 1), datetime(2024, 2, 2)


def outcome(spark, rows, rules=RULES, schema=SCHEMA):
    result = run_row_checks(spark.createDataFrame(rows, schema), rules)
    good = sorted(r["id"] for r in result.good_df.collect())
    rejects = {r["id"]: r["_reject_reason"] for r in result.rejects_df.collect()}
    return good, rejects


@pytest.mark.parametrize("fare, reason", [
    (-0.01, "range:fare"), (0.0, None), (500.0, None), (500.01, "range:fare"), (None, None), (float("nan"), "range:fare"),
])
def test_numeric_range(spark, fare, reason):
    good, rejects = outcome(spark, [(1, 1, T1, T2, fare)])
    assert rejects.get(1) == reason and (good == [1]) == (reason is None)


@pytest.mark.parametrize("pickup, reason", [
    (datetime(2023, 12, 31, 23, 59, 59), "ts_range:t1"), (datetime(2024, 1, 1), None), (datetime(2024, 6, 1), "ts_range:t1"),
    (None, None),
])
def test_timestamp_range(spark, pickup, reason):
    _, rejects = outcome(spark, [(1, 1, pickup, datetime(2025, 1, 1), 1.0)])
    assert rejects.get(1) == reason


def test_timestamp_range_on_text(spark):
    _, rejects = outcome(spark, [(1, "2023-05-01"), (2, "2024-05-01"), (3, "what")],
                         [RULES[2] | {"column": "t"}], "id int, t string")
    assert rejects == {1: "ts_range:t"}


def test_order_and_joined_reasons(spark):
    rows = [(1, 1, T2, T1, 1.0), (2, 2, T1, T1, 1.0), (3, None, T2, T1, -1.0), (4, 4, T1, None, 1.0)]
    good, rejects = outcome(spark, rows)
    assert good == [2, 4]
    assert rejects == {1: "ts_order:t1>t2", 3: "null:a,ts_order:t1>t2,range:fare"}


def test_primary_key_only_among_good_rows(spark):
    rows = [(1, 7, T1, T2, 1.0), (2, 7, T1, T2, 1.0), (3, 8, T1, T2, 1.0), (4, 8, T1, T2, 900.0)]
    good, rejects = outcome(spark, rows)
    assert good == [1, 3] and rejects == {2: "duplicate_pk", 4: "range:fare"}


def test_no_rules_and_unknown_rule(spark):
    df = spark.range(3)
    result = run_row_checks(df, None)
    assert result.good_df.count() == 3 and result.rejects_df.count() == 0
    assert "_reject_reason" in result.rejects_df.columns
    with pytest.raises(KeyError, match="is no row rule"):
        run_row_checks(df, [{"rule": "guess"}])


def test_rule_list_forms():
    rule = {"rule": "not_null", "columns": ["a"]}
    for form in ([rule], rule, {"validation": [rule]}, {"silver": {"validation": [rule]}}):
        assert rule_items(form) == [rule]
    assert rule_items(None) == [] and rule_items("text") == []


def test_older_keyword_form(spark):
    rules = quality_rules(["a"], ("t1", "t2"), {"fare": {"min": 0}}, {"t1": {"max": "2024-06-01"}})
    _, rejects = outcome(spark, [(1, None, T2, T1, -1.0)], rules)
    assert rejects == {1: "null:a,ts_order:t1>t2,range:fare"}


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "x", 0)], "a int, b string, extra int")
    config = {"validation": [{"rule": "schema", "expected": {"a": "integer", "b": "double", "c": "date"}}]}
    checked = run_schema_checks(df, config, "d")
    assert not checked.ok and checked.errors == ("b: got string, expected double", "missing column: c")
    assert run_schema_checks(df, {"validation": [{"rule": "schema", "expected": {"a": "long"}}]}).ok
    assert require_schema(df, {"a": "long"}, "d")["ok"]
    with pytest.raises(ValueError, match="missing=\\['c'\\]"):
        require_schema(df, {"c": "date"}, "d")


def test_summary(spark):
    rows = [(i, i % 4, T1, T2, 1.0 if i < 9 else -1.0) for i in range(12)]
    result = run_row_checks(spark.createDataFrame(rows, SCHEMA), RULES)
    row = validation_summary(result, "d").first()
    assert (row["kept"], row["rejected"], row["rejection_rate_pct"]) == (4, 8, 66.67)
    assert {r["reason"]: r["records"] for r in reject_counts(result).collect()} == {"duplicate_pk": 5, "range:fare": 3}


def test_skewed_keys_split_exactly(spark):
    """One key holds two thirds of the rows, most of them exact copies, and some keys are null."""
    draw = random.Random(5)
    rows = [(1, draw.choice([1, 1, 1, 2, 3])) for _ in range(4000)] + [
        (draw.choice([None, *range(2, 600)]), draw.randrange(4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(16)
    kept = [tuple(r) for r in keys.first_per_key(df, ["k"]).collect()]
    rest = [tuple(r) for r in keys.repeats_per_key(df, ["k"]).collect()]
    assert Counter(kept) + Counter(rest) == Counter(rows)
    assert len(kept) == len({k for k, _ in rows})
    smallest = {}
    for k, v in rows:
        smallest[k] = min(v, smallest.get(k, v))
    assert dict(kept) == smallest


def test_upsert_inserts_each_new_key_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z"), (None, "m"), (None, "o")], "k int, v string")
    assert sorted(rows_to_insert(source, target, ["k"]).collect(), key=str) == [(3, "y"), (None, "m")]
    assert rows_to_insert(source, target, ["k"], null_safe=True).collect() == [(3, "y")]


def test_upsert_prunes_target_partitions(spark, tmp_path):
    target = spark.range(100).select("id", (F.col("id") / 10).cast("int").alias("day"))
    target.write.partitionBy("day").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(45, 125).select("id", (F.col("id") / 10).cast("int").alias("day"))
    fresh = rows_to_insert(source, stored, ["id", "day"], prune_by="day")
    assert sorted(r["id"] for r in fresh.collect()) == list(range(100, 125))
    assert "PartitionFilters: [isnotnull(day" in fresh._jdf.queryExecution().executedPlan().toString()
