"""Embedding whitening: leading principal components of the different vectors, and every vector in their coordinates.

1. Entries become whole numbers, ``x = floor(SCALE * entry)``, the fit list being each different x vector once.  Sums are
   exact; the covariance is summed up over the tasks from vectors that are centred first.
2. On the driver, whose work depends on the dimension alone: Householder reflections make the covariance tridiagonal,
   bisection on Sturm counts finds the leading eigenvalues, inverse iteration their vectors, those of close eigenvalues
   being kept orthogonal to each other; the reflections bring them back.
3. The components go to all tasks with the projection, one map pass over the vectors.

A row whose vector is null, or holds a null, infinite or undefined entry, is left out.  Shorter vectors count as ended by
zeros up to the longest one; entries whose x does not fit a long get the nearest long.  Equal vectors, repeated rows
included, are one entry of the fit list and get equal results.  A component whose eigenvalue is zero up to rounding
(all vectors equal, or fewer different vectors than components) has null instead of whitened coordinates, and so has
``deviation`` where it does not fit a long.  There are as many components as asked for, or as the vectors have entries.
No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import common

SCALE, COMPONENTS = 256, 4
#: Rows of a batch that one matrix product takes.
ROWS = 4096
#: Eigenvalues closer than this share of the largest belong to one cluster.
CLUSTER = 1e-3
LONGEST = 2**63 - 1


# --- eigenvectors of a symmetric matrix ------------------------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections): Householder vectors u, of which the k-th acts on places k + 1 and later."""
    a = a.copy()
    size, reflections = len(a), []
    for k in range(size - 2):
        column = a[k + 1 :, k]
        largest = np.abs(column).max()
        u = np.zeros_like(column)
        if largest and np.any(column[1:]):
            u = column / largest
            u[0] += np.copysign(np.sqrt(u @ u), u[0])
            u /= np.sqrt(u @ u)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ u
            w = 2 * (p - (u @ p) * u)
            rest -= np.outer(u, w) + np.outer(w, u)
            a[k + 1 :, k] = column - 2 * u * (u @ column)
        reflections.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def reflected_back(vectors: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Columns in the coordinates of the tridiagonal matrix, brought to those of the first one."""
    for k in range(len(reflections) - 1, -1, -1):
        u = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(u, u @ vectors[k + 1 :])
    return vectors


def count_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of the points."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.concatenate([[0.0], off * off])
    below, q = np.zeros(len(points), dtype=int), np.ones(len(points))
    for d, s in zip(diagonal, squares, strict=True):
        q = d - points - s / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection until the interval holds no further number."""
    size = len(diagonal)
    around = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    slack = np.finfo(float).eps * size * max(np.abs(diagonal).max(), around.max(), np.finfo(float).tiny)
    low = np.full(count, (diagonal - around).min() - slack)
    high = np.full(count, (diagonal + around).max() + slack)
    wanted = size - np.arange(count)  # the k-th largest has size - k + 1 eigenvalues at or below it
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return high
        above = count_below(diagonal, off, middle) < wanted
        low, high = np.where(open_ & above, middle, low), np.where(open_ & ~above, middle, high)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = right, by elimination with row exchanges; pivots below ``least`` become it."""
    size = len(diagonal)
    main, upper, second = diagonal - shift, np.append(off, 0.0), np.zeros(size)
    lower, x = off.copy(), right.copy()
    for k in range(size - 1):
        if abs(lower[k]) > abs(main[k]):
            main[k], lower[k] = lower[k], main[k]
            upper[k], main[k + 1] = main[k + 1], upper[k]
            second[k], upper[k + 1] = upper[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if abs(main[k]) < least:
            main[k] = least
        factor = lower[k] / main[k]
        main[k + 1] -= factor * upper[k]
        upper[k + 1] -= factor * second[k]
        x[k + 1] -= factor * x[k]
    if abs(main[-1]) < least:
        main[-1] = least
    for k in range(size - 1, -1, -1):
        after = upper[k] * x[k + 1] if k + 1 < size else 0.0
        after += second[k] * x[k + 2] if k + 2 < size else 0.0
        x[k] = (x[k] - after) / main[k]
        if abs(x[k]) > 1e100:  # only the direction counts
            x /= 1e100
    return x


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as columns, by inverse iteration."""
    norm = max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0.0, np.finfo(float).tiny)
    least = np.finfo(float).eps * norm
    start, found = np.random.default_rng(1), []
    first_of_cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first_of_cluster = k
        x = start.standard_normal(len(diagonal))
        for _ in range(6):
            x = solve_shifted(diagonal, off, value, x, least)
            x /= np.abs(x).max()
            for _ in range(2):
                for other in found[first_of_cluster:]:
                    x -= (other @ x) * other
            x /= np.sqrt(x @ x)
        found.append(x)
    return np.array(found).reshape(len(values), len(diagonal)).T


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.abs(matrix).max() if matrix.size else 0.0
    if not scale:
        return np.zeros(count), np.eye(len(matrix), count)
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, count)
    return values * scale, reflected_back(vectors_of(diagonal, off, values), reflections)


# --- fitting ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """``components`` has one row per component; ``usable`` tells which of them have an eigenvalue above rounding."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float
    usable: np.ndarray
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of coordinates, undefined for components that are not usable."""
        roots = np.sqrt(np.where(self.usable, self.values, np.nan))
        return (x - self.mean) @ self.components.T / roots


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable_rows(rows: DataFrame, vector: str) -> DataFrame:
    sound = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return rows.filter(F.coalesce(sound, F.lit(False)))


def ended_by_zeros(x: Column, size: int) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(x)))


def matrices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whole numbers as a matrix) for slices of a batch."""
    for at in range(0, batch.num_rows, ROWS):
        values = batch.column(column).slice(at, ROWS)
        yield at, values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), size)


def fit_list(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Each different vector of whole numbers once (column x), written; and the number of entries they all have."""
    fit = common.stage(usable_rows(rows, vector).select(whole_numbers(F.col(vector)).alias("x")).distinct(), "vectors")
    shortest, longest = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != longest:
        fit = common.stage(fit.select(ended_by_zeros(F.col("x"), longest).alias("x")).distinct(), "vectors")
    return fit, longest or 0


def counted(fit: DataFrame, size: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and the exact sum of each entry.  One row per entry comes back."""
    low = (1 << 32) - 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * size
        for batch in batches:
            for _, x in matrices(batch, "x", size):
                n += len(x)
                parts = zip((x >> 32).sum(axis=0).tolist(), (x & low).sum(axis=0).tolist(), strict=True)
                totals = [t + (high << 32) + rest for t, (high, rest) in zip(totals, parts, strict=True)]
        if n:
            totals = pa.array(list(map(Decimal, totals)), pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(range(size), pa.int32()), totals, pa.array([n] * size, pa.int64())], names=["place", "part", "rows"])

    if not size:
        return fit.count(), ()
    parts = fit.mapInArrow(partial, "place int, part decimal(38,0), rows long")
    sums = parts.groupBy("place").agg(F.sum("part").alias("total"), F.sum("rows").alias("n"))
    found = {r["place"]: (r["n"], int(r["total"])) for r in sums.collect()}
    return (found[0][0], tuple(found[k][1] for k in range(size))) if found else (0, ())


def summed_matrix(fit: DataFrame, size: int, columns: int, rows_of) -> np.ndarray:
    """The sum over all vectors of ``rows_of(x).T @ rows_of(x)``.

    Each task adds up its own vectors; the sums over tasks are Spark's, one row for each place of the matrix, so that
    what the driver gets depends on the size of the matrix alone.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns, columns))
        for batch in batches:
            for _, x in matrices(batch, "x", size):
                y = rows_of(x)
                total += y.T @ y
        i, j = np.tril_indices(columns)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "part"])

    parts = fit.mapInArrow(partial, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("total"))
    out = np.zeros((columns, columns))
    for r in parts.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def summed(fit: DataFrame, size: int, columns: int, rows_of) -> np.ndarray:
    """The sum over all vectors of ``rows_of(x)``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(columns)
        for batch in batches:
            for _, x in matrices(batch, "x", size):
                total += rows_of(x).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(columns), pa.int32()), pa.array(total)], names=["i", "part"])

    parts = fit.mapInArrow(partial, "i int, part double").groupBy("i").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(columns)
    for r in parts:
        out[r["i"]] = r["total"]
    return out


def fit_whitening(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Leading components of the fit list of ``rows``, and how far its whitened covariance is from the identity."""
    fit, size = fit_list(rows, vector)
    n, sums = counted(fit, size)
    count = min(components, size)
    if not n or not count:
        return Whitening(n, sums, np.zeros((count, size)), np.zeros(count), 0.0, np.zeros(count, dtype=bool))
    mean = np.array([s / n for s in sums])
    covariance = summed_matrix(fit, size, size, lambda x: x - mean) / n
    values, vectors = leading_components(covariance, count)
    usable = values > size * np.finfo(float).eps * max(values[0], 0.0)
    model = Whitening(n, sums, np.ascontiguousarray(vectors.T), values, float(np.trace(covariance)), usable)
    left = int(usable.sum())
    if not left:
        return model
    middle = summed(fit, size, left, lambda x: model.whiten(x)[:, :left]) / n
    whitened = summed_matrix(fit, size, left, lambda x: model.whiten(x)[:, :left] - middle) / n
    error = float(np.abs(whitened - np.eye(left)).max())
    return replace(model, identity_error=error)


# --- projection ------------------------------------------------------------------------------------------------------


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """sum over entries of (n * x - S)^2 for each row, in whole numbers of any length."""
    middle = [round(s / n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    reach = max(map(abs, middle)) + max(int(x.max()), -int(x.min())) if x.size else 0
    if reach * max(reach, *map(abs, rest)) * len(sums) < 2**62:
        # Measured from a whole number near the mean, all sums fit a long but the last products.
        away = x - np.array(middle)
        squares, products = (away * away).sum(axis=1).tolist(), (away @ np.array(rest)).tolist()
        base = sum(r * r for r in rest)
        found = [n * n * q - 2 * n * p + base for q, p in zip(squares, products, strict=True)]
    else:
        found = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [f if f <= LONGEST else None for f in found]


def project(rows: DataFrame, model: Whitening, vector: str = "embedding", out: str = "whitening") -> DataFrame:
    """The rows that have a sound vector with a struct column ``out``: deviation, and whitened coordinates as an array."""
    rows = usable_rows(rows, vector)
    size = len(model.sums)
    x = common.fresh("x", [*rows.columns, out])
    if not size:
        empty = F.struct(F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return rows.withColumn(out, empty)
    kind = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    schema = T.StructType([*rows.schema.fields, T.StructField(out, kind)])
    arrow = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, numbers in matrices(batch, x, size):
                coordinates = model.whiten(numbers)
                flat = pa.array(coordinates.reshape(-1), from_pandas=True)
                ends = pa.array(np.arange(len(numbers) + 1) * coordinates.shape[1], pa.int32())
                made = pa.StructArray.from_arrays(
                    [pa.array(deviations(numbers, model.n, model.sums), pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                    fields=list(arrow),
                )
                kept = batch.slice(at, len(numbers)).columns[:-1]
                yield pa.record_batch([*kept, made], names=schema.names)

    return rows.withColumn(x, ended_by_zeros(whole_numbers(F.col(vector)), size)).mapInArrow(run, schema)


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per sound row of ``rows`` (vec_id, embedding) and component."""
    rows = rows.select("vec_id", "embedding")
    model = fit_whitening(rows, components=components)
    share = [float(v / model.trace) if model.trace else None for v in model.values]
    each = project(rows, model).select("vec_id", "whitening", F.posexplode("whitening.whitened").alias("place", "value"))
    explained = F.lit(None).cast("double")
    for k, s in enumerate(share):
        explained = F.when(F.col("place") == k, F.lit(s).cast("double")).otherwise(explained)
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("whitening.deviation").alias("deviation"), F.col("value").alias("whitened"), explained.alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
