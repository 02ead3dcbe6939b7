"""Equality of two results without collecting either."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.scratch import stage

# Rows of both frames that one task compares.
ROWS_PER_TASK = 500_000
# Deviations from which on a sum of hashes speaks of one row with many copies.
HEAT = 6


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one frame holds more often than the other, columns matched by name; ``_surplus`` is how much more often
    the left one does.  One pass over each frame."""
    return _unbalanced(_signed(left, right), left.columns)


def _signed(left: DataFrame, right: DataFrame) -> DataFrame:
    one = lambda df, n: df.select(*left.columns).withColumn("_surplus", F.lit(n))
    return one(left, 1).unionByName(one(right, -1))


def _unbalanced(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    return both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_surplus").alias("_surplus")).filter("_surplus <> 0")


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True when both frames hold the same rows the same number of times, in any order."""
    return sorted(left.columns) == sorted(right.columns) and differences(left, right).isEmpty()


# --- by fingerprints ------------------------------------------------------------------------------------------------


def _hashable(field: T.StructField) -> Column:
    """The column in a form in which equal values have equal hashes: one zero, and maps as sorted entries."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column + F.lit(0.0).cast(field.dataType)
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(column))
    return column


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A hash of the values and of which of them are null; the null marks keep (null, x) and (x, null) apart."""
    values = [_hashable(df.schema[c]) for c in columns]
    nulls = F.concat_ws("", *[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(nulls, *values)


def fingerprints(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Per partition the number of its rows and the sum of their hashes, which no order of the rows changes.

    One pass; a task keeps a count and a sum for each partition it meets, and no row is shuffled.
    """
    total = F.sum(row_hash(df, list(columns or df.columns)).cast("decimal(38,0)"))
    return df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.count(F.lit(1)).alias("_rows"), total.alias("_hash"))


def _differing_prints(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The partitions whose rows are not the same, with the rows and sums of hashes of both sides."""
    prints = lambda df, side: fingerprints(df, by, left.columns).withColumnsRenamed({"_rows": f"{side}_rows", "_hash": f"_{side}"})
    first, second = prints(left, "left"), prints(right, "right")
    other = second.withColumnsRenamed({c: f"_r_{c}" for c in by})
    match = [first[c].eqNullSafe(other[f"_r_{c}"]) for c in by]
    both = first.withColumn("_l", F.lit(True)).join(other.withColumn("_r", F.lit(True)), match, "full")
    keys = [F.when(F.col("_l"), F.col(f"`{c}`")).otherwise(F.col(f"`_r_{c}`")).alias(c) for c in by]
    zero = F.lit(0).cast("long")
    return both.filter(~F.col("_left").eqNullSafe(F.col("_right")) | ~F.col("left_rows").eqNullSafe(F.col("right_rows"))).select(
        *keys, F.coalesce("left_rows", zero).alias("left_rows"), F.coalesce("right_rows", zero).alias("right_rows"), "_left", "_right"
    )


def differing_partitions(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, left_rows, right_rows) of the partitions whose rows are not the same; nulls are a partition as well."""
    return _differing_prints(left, right, by).drop("_left", "_right")


def _hot(side: str) -> Column:
    """Whether a side of a partition seems to hold one row many times.

    Hashes of different rows cancel out: their sum stays within a few roots of their number.  Copies of a row add up.
    """
    deviation = F.sqrt(F.col(f"{side}_rows") / 3) * float(2**63)
    return F.coalesce(F.abs(F.col(f"_{side}").cast("double")) > HEAT * deviation, F.lit(False)) & (F.col(f"{side}_rows") > ROWS_PER_TASK)


def differences_by_partition(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """``differences``, looked for only in the partitions whose fingerprints differ: where both frames are equal, or
    nearly, hardly a row is shuffled.

    The fingerprints are computed at once and written.  They tell how many rows are left, and these are dealt out so that
    a task compares about ``ROWS_PER_TASK``, whatever the sizes of files and shuffle partitions.  Only where a row
    seems to have many copies are rows combined before the shuffle, in as much memory as their different ones take.
    """
    prints = stage(_differing_prints(left, right, by), "differing-partitions")
    rows, hot = prints.agg(F.sum(F.col("left_rows") + F.col("right_rows")), F.max(_hot("left") | _hot("right"))).first()
    parts = prints.select(*[F.col(f"`{c}`").alias(f"_p_{c}") for c in by])

    def within(df: DataFrame) -> DataFrame:
        return df.join(parts, [df[c].eqNullSafe(parts[f"_p_{c}"]) for c in by], "left_semi")

    both = _signed(within(left), within(right))
    if hot:
        return _unbalanced(both, left.columns)
    tasks = max(1, math.ceil((rows or 0) / ROWS_PER_TASK))
    # A number that equal rows share; some for each task, so that tasks are of like size.
    spread = F.pmod(row_hash(both, left.columns), F.lit(16 * tasks))
    dealt = both.withColumn("_spread", spread).repartition(tasks, "_spread")
    return _unbalanced(dealt, ["_spread", *left.columns]).drop("_spread")
