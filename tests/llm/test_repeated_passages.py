"""Substring dedup against brute force and SQL, over several layouts, task sizes and lengths."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, repeated_passages

DOCS = "doc_id long, text string, source string"


def brute(rows, words):
    """(doc_id, n_words, n_removed, kept_sha256) per row, in the order of the rows; doc_ids may repeat but not be null."""
    earliest, out = {}, []
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    for (doc, _), found in zip(rows, split, strict=True):
        for i in range(len(found) - words + 1):
            key = tuple(found[i : i + words])
            earliest[key] = min(doc, earliest.get(key, doc))
    for (doc, _), found in zip(rows, split, strict=True):
        gone = {
            i + k for i in range(len(found) - words + 1) if earliest[tuple(found[i : i + words])] < doc for k in range(words)
        }
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        out.append((doc, len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def some_rows():
    draw = random.Random(7)
    make = lambda n: draw.choices(["ka", "lo", "mi", "é", "漢字", "Ru", "x y", "\x1c"], k=n)
    passage, line = make(40), make(13)
    blanks = [" ", "\n", "\t ", "  ", "\r\n", "\x0b"]
    rows = []
    for i in range(60):
        words = make(draw.randint(0, 80))
        for extra in draw.sample([passage[: draw.randint(10, 40)], line, line[:12], passage[5:], []], k=2):
            at = draw.randint(0, len(words))
            words[at:at] = extra
        rows.append((draw.randint(-5, 50) * 1000 + i, "".join(w + draw.choice(blanks) for w in words)))
    long = make(30_000)
    rows += [(7, " ".join(long)), (70_001, " ".join(long[100:20_000])), (-9, None), (8, ""), (9, " \n"), (10, "a" * 50_000), (11, "a" * 50_000)]
    rows += [(80_000, "a b " * 40), (80_001, "a b " * 30), (80_002, " ".join(["z" * 5000] * 20)), (80_003, " ".join(["z" * 5000] * 14))]
    return rows + [rows[0], rows[3], rows[3], rows[-1]]


def found_in(df, words):
    return sorted(tuple(r)[:4] for r in repeated_passages.verdicts(df, words).collect())


@pytest.mark.parametrize(("words", "chunk"), [(13, 12_000_000), (13, 900), (13, 1), (5, 900), (50, 3000)])
def test_against_brute_force(spark, words, chunk, monkeypatch):
    monkeypatch.setattr(repeated_passages, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(repeated_passages, "HASHED_BYTES", 1000)
    rows = some_rows()
    table = spark.createDataFrame([(*r, "s") for r in rows], DOCS).repartition(5)
    assert found_in(table, words) == sorted(brute(rows, words))


def test_layouts_agree_and_other_columns_stay(spark):
    rows = some_rows()
    table = spark.createDataFrame([(*r, "s") for r in rows], DOCS)
    for n in ("hash", "doc", "mark", "lost", "answers", "packs"):
        table = table.withColumn(n, F.lit("x"))
    layouts = [found_in(t, 13) for t in (table.coalesce(1), table.repartition(9))]
    assert layouts[0] == layouts[1] == sorted(brute(rows, 13))
    out = repeated_passages.dedup(table)
    assert out.columns == [*table.columns, "passages"]
    for r in out.collect():
        p, words = r["passages"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        spans = list(zip(p["removed"][0::2], p["removed"][1::2], strict=True))
        assert all(e - s >= 13 for s, e in spans) and sum(e - s for s, e in spans) == p["n_removed"]
        assert p["kept"] == " ".join(w for i, w in enumerate(words) if not any(s <= i < e for s, e in spans))


def test_rows_without_doc_id(spark):
    text = " ".join(str(k) for k in range(20))
    rows = [(None, text), (None, text), (None, text + " more"), (3, "own " + text), (None, None)]
    found = repeated_passages.verdicts(spark.createDataFrame([(*r, "s") for r in rows], DOCS)).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in found) == [(0, 0), (20, 20), (20, 20), (21, 0), (21, 20)]
    alone = repeated_passages.verdicts(spark.createDataFrame([(*r, "s") for r in rows if r[0] is None], DOCS)).collect()
    assert sum(r["n_removed"] > 0 for r in alone) in (1, 2)  # the text of smaller hash keeps its words
    assert repeated_passages.verdicts(spark.createDataFrame([], DOCS)).collect() == []


def test_levels_double():
    assert repeated_passages.levels(13) == [7, 13] and repeated_passages.levels(50) == [7, 13, 25, 50]
    assert repeated_passages.levels(5) == [5]
    for words in range(1, 200):
        steps = repeated_passages.levels(words)
        assert steps[-1] == words and all(a < b <= 2 * a for a, b in zip(steps, steps[1:], strict=False))


def test_the_first_level_loses_no_equal_window():
    """Equal windows choose equal short windows, wherever they stand."""
    draw = random.Random(1)
    passage = " ".join(draw.choices("abcdefgh", k=30))
    one, two = (repeated_passages.Windows(repeated_passages.Texts(pa.array([t])), 13) for t in (passage, "x y z " + passage + " q"))
    assert one.keys(7).tolist() == two.keys(7).tolist()[3:-1] and one.keys(13).tolist() == two.keys(13).tolist()[3:-1]


def test_a_passage_everywhere_sends_one_row_per_task(spark):
    """The rows that are compared between tasks do not grow with the documents that share a window."""
    line = " ".join(f"w{k}" for k in range(20))
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + " own"), "id").alias("text")).coalesce(4)
    documents = repeated_passages.owned(many, *repeated_passages.OWNER).select(*repeated_passages.OWNER, "text")
    batches = documents.toArrow().to_batches()
    owners = np.column_stack([batches[0].column(n).to_numpy() for n in repeated_passages.OWNER])
    windows = repeated_passages.Windows(repeated_passages.Texts(batches[0].column(2)), 13)
    said = repeated_passages.rows_of(owners, windows.keys(13), windows.keys(13, 2), windows.text, True)
    settled = said.column("settled").is_null().to_pylist()
    assert sum(settled) == len(set(windows.keys(13).tolist())) and settled.count(False) == batches[0].num_rows - 1
    assert repeated_passages.compared(documents, 13, 13, None).count() == 3999
    verdict = repeated_passages.verdicts(many).agg(F.sum("n_removed"), F.max("n_removed")).first()
    assert tuple(verdict) == (3999 * 20, 20)


def test_the_whole_table_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    wanted = sorted(db.sql(queries.ORACLES["op13_substring_dedup"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op13_substring_dedup"](spark, sf).collect()) == wanted
