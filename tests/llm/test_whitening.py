"""Whitening against dense eigenvectors, whole numbers of any length and awkward tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>"


def whole(vector):
    return tuple(math.floor(256 * float(np.float32(c))) for c in vector)


def brute(vectors, count=4):
    """(n, sums, leading eigenvalues, their vectors as rows, trace) of the different vectors of whole numbers."""
    x = np.array(sorted(set(vectors)), dtype=float)
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    values, columns = np.linalg.eigh(v)
    return len(x), [sum(c) for c in zip(*set(vectors), strict=True)], values[::-1][:count], columns.T[::-1][:count], np.trace(v)


def compare(rows, vectors):
    """Rows (by vec_id and component) against the dense computation; vectors: vec_id -> whole numbers."""
    n, sums, values, components, trace = brute(list(vectors.values()))
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert set(got) == {(i, k + 1) for i in vectors for k in range(len(values))}
    for k, (value, component) in enumerate(zip(values, components, strict=True)):
        expected = np.array([(np.array(x) - np.array(sums) / n) @ component / math.sqrt(value) for x in vectors.values()])
        found = np.array([got[i, k + 1]["whitened"] for i in vectors])
        assert min(np.abs(found - expected).max(), np.abs(found + expected).max()) < 1e-7
    for i, x in vectors.items():
        for k, value in enumerate(values):
            r = got[i, k + 1]
            assert r["n"] == n and r["deviation"] == sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))
            assert r["explained"] == pytest.approx(value / trace, rel=1e-9) and r["identity_error"] < 1e-9


def test_eigenvectors_are_those_of_a_dense_solver():
    draw = np.random.default_rng(0)
    for size in (1, 2, 3, 5, 20, 64, 150):
        for rank in (size, max(1, size // 3)):
            b = draw.standard_normal((size, rank))
            a, count = b @ b.T, min(4, size)
            values, columns = whitening.leading_components(a, count)
            scale = max(1.0, np.abs(a).max() * size)
            assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:count]).max() < 1e-13 * scale
            assert np.abs(a @ columns - columns * values).max() < 1e-13 * scale
            assert np.abs(columns.T @ columns - np.eye(count)).max() < 1e-13


@pytest.mark.parametrize("diagonal", [[3.0] * 6, [5.0, 5, 5, 1, 1, 1], [0.0] * 5, [1e-300, 2e-300, 3e-300, 4e-300], [1 + 1e-13, 1, 1, 1 - 1e-13, 0.5]])
def test_equal_and_close_eigenvalues_have_orthogonal_vectors(diagonal):
    draw = np.random.default_rng(1)
    q = np.linalg.qr(draw.standard_normal((len(diagonal), len(diagonal))))[0]
    for a in (np.diag(diagonal), q @ np.diag(diagonal) @ q.T):
        a = (a + a.T) / 2
        values, columns = whitening.leading_components(a, 4)
        assert np.allclose(values, sorted(diagonal)[::-1][:4], rtol=1e-12, atol=0 if max(diagonal) < 1 else 1e-14)
        assert np.abs(columns.T @ columns - np.eye(4)).max() < 1e-13
        assert np.abs(a @ columns - columns * values).max() <= 1e-13 * max(diagonal)


def test_sturm_counts_are_eigenvalues_below():
    draw = np.random.default_rng(2)
    d, e = draw.standard_normal(30), draw.standard_normal(29)
    e[7] = 0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = draw.standard_normal(50) * 2
    assert whitening.count_below(d, e, points).tolist() == [(values < p).sum() for p in points]


@pytest.mark.parametrize("reach", [300, 2**33, 2**61])
def test_deviations_are_exact(reach):
    draw = np.random.default_rng(3)
    x = draw.integers(-reach, reach, (40, 5))
    for n in (1, 17, 10**11):
        sums = tuple(int(s) * n // 3 + 1 for s in draw.integers(-reach, reach, 5))
        wanted = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
        assert whitening.deviations(x, n, sums) == [w if w < 2**63 else None for w in wanted]


def test_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: whole(r["embedding"]) for r in rows}
    compare(queries.QUERIES["op11_embedding_whitening"](spark, sf).collect(), vectors)


def test_awkward_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.standard_normal(6).tolist()) for i in range(40)]
    rows += [(i + 100, rows[0][1]) for i in range(60)]  # copies count once
    dropped = [(900, None), (901, [1.0, None] * 3), (902, [math.nan] * 6), (903, [1.0] * 5 + [math.inf])]
    short = [(800, [0.5, -0.25]), (801, [0.5, -0.25, 0.0, 0.0, 0.0, 0.0]), (802, [])]
    table = spark.createDataFrame(rows + dropped + short + [rows[1]], VECTORS)
    table = table.withColumn("x", F.lit("x")).withColumn("component", F.lit(7)).withColumn("whitening", F.lit(1))
    vectors = {i: whole([*v, *[0.0] * (6 - len(v))]) for i, v in rows + short}
    found = whitening.whitened(table).collect()
    assert sum(r["vec_id"] == 1 for r in found) == 8
    compare(found, vectors)
    layouts = [sorted((r["vec_id"], r["component"], r["deviation"]) for r in whitening.whitened(t).collect()) for t in (table.repartition(7), table.coalesce(1))]
    assert layouts[0] == layouts[1] == sorted((r["vec_id"], r["component"], r["deviation"]) for r in found)


def test_too_few_different_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (None, [2.0, 2.0, 3.0])], VECTORS)
    found = {(r["vec_id"], r["component"]): r for r in whitening.whitened(table).collect()}
    assert len(found) == 9 and abs(found[None, 1]["whitened"]) == pytest.approx(1) and found[1, 1]["identity_error"] < 1e-12
    assert all(r["whitened"] is None for (_, k), r in found.items() if k > 1)
    same = whitening.whitened(table.filter("vec_id is not null")).collect()
    assert len(same) == 6 and all(r["n"] == 1 and r["whitened"] is None and r["deviation"] == 0 for r in same)
    for empty in (table.filter("false"), spark.createDataFrame([(1, []), (2, None)], VECTORS)):
        assert whitening.whitened(empty).collect() == []


def test_entries_beyond_a_long(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    found = whitening.whitened(table).collect()
    assert len(found) == 4 and all(r["deviation"] is None for r in found)
    assert sorted(round(r["whitened"], 9) for r in found if r["component"] == 1) == [-1, 1]


def test_other_columns_stay_in_the_general_interface(spark):
    table = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "b", [2.0, 1.0]), (3, "c", [0.0, 0.5])], "k int, name string, v array<double>")
    out = whitening.project(table, whitening.fit_whitening(table, "v", 2), "v", "coordinates")
    assert out.columns == ["k", "name", "v", "coordinates"]
    w = np.array([r["coordinates"]["whitened"] for r in out.collect()])
    assert np.abs(w.T @ w / 3 - np.eye(2)).max() < 1e-12
