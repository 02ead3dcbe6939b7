"""First row per key and the rows beyond it, safe for keys that hold a large share of the table.

The kept row is the smallest by content (the non-key columns in order), which makes the choice independent of
row order.  ``first_per_key`` filters a row number down to one, which Spark turns into a group limit on the map
side, so each task ships at most one row per key.  ``first_given_repeated`` does without even that shuffle once the
few repeated keys have been written out.  ``repeats_per_key`` needs the other rows: where no key is hot it ranks them
after one shuffle by key, else it first narrows to the keys that repeat and then ranks in two steps, inside a salt and
across salts, so that no task ever receives all rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from strata.operators.lookup import fits_broadcast

# Pieces a hot key is cut into; at most this many leaders meet in one task.
SALTS = 16_384
# Rows from which on a key is hot: fewer are ranked in one task.
HOT_ROWS = 1_000
# Pieces a hot key is cut into while its rows are looked up among the repeated keys.
LOOKUP_PARTS = 16


def _content_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> list[Column]:
    declared = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order_by]
    named = {o for o in order_by if isinstance(o, str)}
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys and c not in named]
    return declared + rest or [F.lit(1).asc()]


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the remaining columns."""
    window = Window.partitionBy(*keys).orderBy(*_content_order(df, keys, order_by))
    return df.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") == 1).drop("_row")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row.  Reads only the key columns and combines before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1).drop("_rows")


def has_hot_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any key has ``HOT_ROWS`` rows or more.  One job over the key columns, combined before the shuffle."""
    return not df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= HOT_ROWS).isEmpty()


def null_safe_match(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    """Equality on all keys that also matches null with null."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def _prefixed(repeated: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeated.select(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys])


def first_given_repeated(
    df: DataFrame,
    keys: Sequence[str],
    repeated: DataFrame,
    cluster_by: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """``first_per_key`` when the repeated keys are at hand and few: the wide rows are not shuffled.

    Rows with a key of their own pass straight from the scan; only the rows of repeated keys are ranked.
    """
    known = _prefixed(repeated, keys)
    match = null_safe_match(df, known, keys, "_k_")
    single = df.join(known, match, "left_anti")
    ranked = first_per_key(df.join(known, match, "left_semi"), keys, order_by)
    return single.unionByName(ranked.hint("rebalance", *cluster_by) if cluster_by else ranked)


def repeats_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] = (),
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Every row that ``first_per_key`` with the same arguments leaves out, copies included.

    Without ``repeated`` a job looks for hot keys first; if there are none, the rows are shuffled once.
    """
    order = _content_order(df, keys, order_by)
    columns = df.columns
    if repeated is None and not has_hot_keys(df, keys):
        # By the whole key: a partitioning by part of it, left by a join, may gather many keys in one task.
        dealt = df.repartition(*[F.col(f"`{k}`") for k in keys])
        numbered = dealt.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return numbered.filter(F.col("_row") > 1).drop("_row")
    hot = _prefixed(repeated_keys(df, keys) if repeated is None else repeated, keys)
    # The input partition spreads exact copies, the content spreads the distinct rows of a key.
    rest = [F.col(f"`{c}`") for c in columns if c not in keys]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.spark_partition_id(), *rest), F.lit(SALTS)))
    match = null_safe_match(salted, hot, keys, "_k_")
    if not fits_broadcast(hot):
        # A shuffled lookup goes by key and part, with every repeated key once in each part.
        hot = hot.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_PARTS - 1))))
        match = null_safe_match(salted, hot, keys, "_k_") & (F.pmod(salted["_salt"], F.lit(LOOKUP_PARTS)) == hot["_part"])
    rows = salted.join(hot, match, "left_semi")
    # An explicit repartition: Spark would otherwise reuse the join's partitioning by key alone for the window.
    spread = rows.repartition(*[F.col(k) for k in keys], F.col("_salt"))
    inside = Window.partitionBy(*keys, "_salt").orderBy(*order)
    local = spread.withColumn("_local", F.row_number().over(inside))
    # Only the leader of each salt competes for the key; the other rows stay spread by salt.
    heat = F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt"))
    across = Window.partitionBy(*keys, "_heat").orderBy(*order)
    ranked = local.withColumn("_heat", heat).withColumn("_rank", F.row_number().over(across))
    return ranked.filter((F.col("_heat") != -1) | (F.col("_rank") != 1)).select(*[f"`{c}`" for c in columns])
