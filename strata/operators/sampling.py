"""Samples: by fraction, and of an exact number of rows at any size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 50_000


def fraction_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Seeded Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_rows(df: DataFrame, n: int, seed: int, total: int | None = None) -> DataFrame:
    """Exactly ``n`` random rows (all of them if there are fewer).

    Every row draws a random number.  The numbers are cut into equal slices and counted; whole slices below the cut are
    taken where they lie and only the slice that straddles it is sorted and limited, so no task holds more than one
    slice.  The running count over slices is made in two levels of about the square root of their number.  ``df`` has to be
    reproducible, such as a file scan with narrow steps, because it is read once for the counts and once for the rows.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    total = df.count() if total is None else total
    if n >= total:
        return df
    slices = max(1, total // ROWS_PER_SLICE)
    wide = max(1, math.isqrt(slices))
    numbered = df.withColumn("_draw", F.rand(seed)).withColumn("_slice", F.floor(F.col("_draw") * slices))
    counts = numbered.groupBy("_slice").agg(F.count("*").alias("_rows"))
    group = F.floor(F.col("_slice") / wide)
    groups = counts.groupBy(group.alias("_at")).agg(F.sum("_rows").alias("_rows"))
    upper = _cut(groups, "_at", n, 0)
    lower = _cut(counts.filter(group == upper["_at"]), "_slice", n, upper["_upto"] - upper["_rows"])
    missing = n - (lower["_upto"] - lower["_rows"])
    whole = numbered.filter(F.col("_slice") < lower["_slice"])
    edge = numbered.filter(F.col("_slice") == lower["_slice"]).orderBy("_draw").limit(missing)
    return whole.unionByName(edge).drop("_draw", "_slice")


def _cut(counts: DataFrame, key: str, n: int, before: int) -> Row:
    """The first key at which the running count, from ``before``, reaches n."""
    running = counts.withColumn("_upto", F.lit(before) + F.sum("_rows").over(Window.orderBy(key)))
    return running.filter(F.col("_upto") >= n).orderBy(key).first()
