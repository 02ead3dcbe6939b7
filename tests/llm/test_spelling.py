"""Spelling variants against brute force over all pairs, and against SQL."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, spelling

DOCS = "doc_id long, text string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, alter=True):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if alter and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(out, key=str)


def found_in(df, **options):
    return sorted((tuple(r) for r in spelling.variants(df, **options).collect()), key=str)


def some_rows():
    draw = random.Random(5)
    stems = ["hello", "hallo", "helllo", "wortéx", "aaaaa", "aaaaaa", "aaaaaaa", "aaaaab", "ÀÉÎÕÜß", "Straße×", "letters", "lettters", "leters"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(draw.randint(0, 30)):
            w = draw.choice(stems)
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", "x", "é", w[at] * 2]) + w[at + draw.randint(0, 1) :]
            words.append(w.upper() if draw.random() < 0.2 else w)
        rows.append((i if i % 7 else None, draw.choice([" ", "1", "\n", "漢"]).join(words)))
    return rows + [(5, None), (6, ""), rows[0], rows[0], (1, "a" * 64 + " " + "a" * 64), (2, "a" * 64 + " " + "a" * 65 + " " + "b" * 63)]


@pytest.mark.parametrize("layout", [1, 7])
def test_against_all_pairs(spark, layout, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 50)
    rows = some_rows()
    table = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).repartition(layout)
    assert found_in(table) == brute(rows)


@pytest.mark.parametrize("long", [1, 5, 6, 64])
def test_long_words_are_told_apart_by_digests(spark, long, monkeypatch):
    """Whatever length counts as long, the results are those of written-out rotations."""
    monkeypatch.setattr(spelling, "LONG", long)
    draw = random.Random(9)
    base = "".join(draw.choices("abcé", k=70))
    edits = [base, base[:-1], base + "a", "b" + base[1:], base[:30] + base[31:], base[:64] + "x" + base[65:], base[:64] + "y" + base[65:]]
    rows = [*some_rows(), *((k, " ".join([w] * (3 + k))) for k, w in enumerate(edits)), (50, " ".join(edits * 2))]
    assert found_in(spark.createDataFrame(rows, DOCS), alter=False) == brute(rows, alter=False)


def test_ties_go_to_the_smallest_word(spark):
    rows = [(1, "worda " * 3 + "wordb " * 6 + "wordc " * 6 + "wordA wordd wordd wordd " + "word " * 9)]
    found = {r[0]: r for r in found_in(spark.createDataFrame(rows, DOCS), alter=False)}
    assert found["wordd"][1:] == ("wordb", "wordb", 3, 3, 6) and found["wordb"][1] is None and found["worda"][3] == 4


def test_chains_lead_to_the_last_form(spark):
    words = ["abcdefgh", "bbcdefgh", "bccdefgh", "bcddefgh", "bcdeefgh", "bcdeffgh"]
    rows = [(1, " ".join(" ".join([w] * (3 * 2**k)) for k, w in enumerate(words)))]
    found = {r[0]: r[2] for r in found_in(spark.createDataFrame(rows, DOCS), alter=False)}
    assert set(found.values()) == {words[-1]}


def test_a_run_of_a_million_letters(spark):
    begun = time.time()
    rows = [(k, "q" * 200_000 + ("z" if k else "")) for k in range(6)]
    found = found_in(spark.createDataFrame(rows, DOCS), alter=False)
    assert [(len(r[0]), r[1]) for r in found] == [(200_001, None)] and time.time() - begun < 60


def test_nothing(spark):
    assert found_in(spark.createDataFrame([], DOCS)) == [] == found_in(spark.createDataFrame([(1, None), (None, "")], DOCS))


def test_every_pair_meets_once():
    draw = random.Random(3)
    words = sorted({"".join(draw.choices("ab", k=draw.randint(3, 6))) for _ in range(60)})
    ranges = {}
    for w in words:
        for key, role in spelling.rotations(w):
            ranges.setdefault(key, []).append((w, 1, role))
    near = Counter()
    for group in ranges.values():
        for w, n, _, _ in spelling.heard(group):
            near[w] += n
    assert {w: near[w] for w in words} == {w: sum(one_edit(w, o) for o in words) for w in words}


def test_the_whole_table_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    wanted = sorted(db.sql(queries.ORACLES["op12_spelling_variants"]).fetchall(), key=str)
    found = sorted((tuple(r) for r in queries.QUERIES["op12_spelling_variants"](spark, sf).collect()), key=str)
    assert found == wanted and len(found) > 1000
