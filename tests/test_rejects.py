"""Repeated rows are ranked after one shuffle where no key is hot, and rejects read a join once."""

from __future__ import annotations

import random
from collections import Counter

import __spark_entry__  # noqa: F401 - registers the queries
from contract.registry import QUERIES
from strata.operators import keys
from strata.operators.rules import run_row_checks

SF = "/root/testdata/sf0.001"


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_keys_of_few_rows_are_shuffled_once(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, *range(300)]), draw.randrange(6)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(16)
    found = keys.repeats_per_key(df, ["k"])
    assert first_plan(found).count("Exchange hashpartitioning") == 1 and "Join" not in first_plan(found)
    first = {}
    for k, v in rows:
        first[k] = min(v, first.get(k, v))
    assert Counter(map(tuple, found.collect())) == Counter(rows) - Counter(first.items())


def test_a_key_becomes_hot_by_its_rows(spark, monkeypatch):
    df = spark.range(90).selectExpr("id % 9 AS k", "id AS v")
    usual = sorted(map(tuple, keys.repeats_per_key(df, ["k"]).collect()))
    assert not keys.has_hot_keys(df, ["k"]) and usual == sorted((i % 9, i) for i in range(9, 90))
    monkeypatch.setattr(keys, "HOT_ROWS", 10)
    assert keys.has_hot_keys(df, ["k"]) and sorted(map(tuple, keys.repeats_per_key(df, ["k"]).collect())) == usual


def test_rejects_join_the_lines_once(spark):
    plan = first_plan(QUERIES["reject_reasons"](spark, SF))
    assert "Join" not in plan and "lineitem.parquet" not in plan


def test_good_rows_alone_look_for_no_hot_key(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a job for rejects that nobody asked for")

    monkeypatch.setattr(keys, "has_hot_keys", refuse)
    result = run_row_checks(spark.range(6).selectExpr("id % 3 AS k"), [{"rule": "primary_key", "columns": ["k"]}])
    assert result.good_df.count() == 3
