"""Results that depend on the table alone and on no order of its rows, long texts, and votes that are estimated."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import main_text, personal_data, quality, toxicity, url_filter

SF = "/root/testdata/sf0.001"


def layouts(df):
    return [df.coalesce(1), df.repartition(7), df.orderBy(F.rand(3)).coalesce(3)]


def test_labels_that_disagree_are_settled_by_majority(spark):
    rows = [(1, 1), (1, 1), (1, 0), (2, 0), (2, 1), (3, 0), (3, None), (4, None), (5, 1), (None, 1)]
    rows += [(k, 1) for k in range(10, 60)] + [(k, 0) for k in range(10, 60, 2)]
    table = spark.createDataFrame(rows, "doc_id long, toxic int").withColumn("fold", F.lit("x"))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    found = [sorted((r["doc_id"], r["toxic"]) for r in toxicity.labelled(docs, t).collect()) for t in layouts(table)]
    assert found[0] == found[1] == found[2]
    held = {r["doc_id"] for r in docs.filter(toxicity.remainder(F.col("doc_id")) == 0).collect()}
    assert found[0] == [(k, t) for k, t in [(1, 1.0), (3, 0.0), (5, 1.0), *((k, 1.0) for k in range(11, 60, 2))] if k not in held]


def test_scores_do_not_follow_the_order_of_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", "toxic").union(labels.select("doc_id", (1 - F.col("toxic")).alias("toxic")).limit(20))
    found = [sorted(tuple(r) for r in toxicity.scores(docs, t).select("doc_id", "predicted").collect()) for t in layouts(labels)[:2]]
    assert found[0] == found[1]


def test_page_texts_do_not_follow_the_order_of_pages(spark, monkeypatch):
    monkeypatch.setattr(main_text, "SAMPLED", 20)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = [sorted((r["page_id"], r["text"]) for r in main_text.main_texts(t).collect()) for t in layouts(pages)]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("text", [
    "7" * 1_000_000, "1." * 500_000, "1.2.3 " * 150_000, "x" * 1_000_000, "a@" * 300_000, "a." * 300_000 + "@b.com",
    "+1(" * 200_000, "1234567." * 60_000, "5 at " * 100_000,
])
def test_base_patterns_are_linear(text):
    begun = time.time()
    personal_data.base_spans(text)
    personal_data.regions(text)
    assert time.time() - begun < 5


def test_ip_search_finds_what_the_pattern_finds():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choices("0123.. a", k=draw.randint(0, 40)))
        assert [m.span() for m in personal_data.IP_FROM_RUN.finditer(text)] == [m.span() for m in personal_data.IP.finditer(text)]


def test_names_and_numbers_of_any_length_are_candidates():
    name = ".".join(f"part{k}" for k in range(200))
    text = f"write to {name} at mail.example.com now"
    [(start, end)] = personal_data.email_regions(text)
    assert text[start:end] == f"{name} at mail.example.com"
    bounds, spans = personal_data.candidates(text, start, end)
    assert any((bounds[i], bounds[j]) == (start, end) for i, j in spans)
    number = "- ".join("4539148803436467")
    bounds, spans = personal_data.candidates(number, 0, len(number))
    assert any((bounds[i], bounds[j]) == (0, len(number)) for i, j in spans)
    table = " ".join(["1234567"] * 5000)
    bounds, spans = personal_data.candidates(table, 0, len(table))
    assert len(spans) <= 3 * 5000
    assert all(len(re.findall("[0-9]", table[bounds[i] : bounds[j]])) <= personal_data.MOST_DIGITS for i, j in spans)


def test_a_rule_whose_stated_accuracy_is_wrong_is_corrected():
    """Votes against at random: by their stated accuracy they would reject what all other rules find fit."""
    draw = np.random.default_rng(0)
    bad = draw.random(20_000) < 0.15
    votes = np.where(bad[:, None] & (draw.random((20_000, 4)) < 0.8), -1, 1)
    noise = np.where(draw.random(20_000) < 0.3, -1, 1)
    patterns = {}
    for row in np.column_stack([votes, noise]).tolist():
        patterns[tuple(row)] = patterns.get(tuple(row), 0) + 1

    def rejected(rounds):
        kept = quality.ROUNDS
        quality.ROUNDS = rounds
        try:
            prior, odds = quality.estimate(patterns, 5)
        finally:
            quality.ROUNDS = kept
        unfit = {p for p in patterns if prior + sum(o[v] for o, v in zip(odds, p, strict=True)) < 0}
        return np.array([tuple(row) in unfit for row in np.column_stack([votes, noise]).tolist()])

    stated, estimated = rejected(0), rejected(quality.ROUNDS)
    assert (stated != estimated).sum() > 3000
    truth = (votes == -1).any(axis=1)
    assert (stated == truth).mean() < 0.8 and (estimated == truth).mean() > 0.99


def test_hot_and_null_urls_are_spread(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "HOT_LEAST", 10)
    hot = "http://free-bets.example.org/x"
    rows = [(k, hot if k % 3 == 0 else None if k % 3 == 1 else f"http://www.example.com/en/{k}") for k in range(3000)] + [(0, hot), (1, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("place", F.lit("x")).withColumn("hot", F.lit("x")).withColumn("n", F.lit(1))
    found = url_filter.verdicts(pages).collect()
    assert len(found) == len(rows)
    seen = {(r["rule"], r["verdict"], r["pattern"] is not None) for r in found if r["page_id"] % 3 == 0}
    assert seen == {(None, "block", True)}
    assert {(r["rule"], r["verdict"], r["host"]) for r in found if r["page_id"] % 3 == 1} == {(None, "allow", "")}
    assert {(r["rule"], r["verdict"]) for r in found if r["page_id"] % 3 == 2} == {("www.example.com/en/", "allow")}


@pytest.mark.parametrize("few", [True, False])
def test_rules_from_tables_are_those_from_lists(spark, monkeypatch, few):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 1000 if few else 2)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    hosts = spark.createDataFrame(url_filter.HOST_RULES, "rule_host string, prefix string, says string")
    patterns = spark.createDataFrame(url_filter.PATTERN_RULES, "pattern string, literals array<string>")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(url_filter.verdicts(pages, hosts, patterns)) == key(url_filter.verdicts(pages))
    none = url_filter.verdicts(pages, hosts.filter("false"), []).select("rule", "pattern", "verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, None, "allow")]
