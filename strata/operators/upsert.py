"""Insert rows whose key is not in the target yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.types import align_to
from strata.operators.keys import first_per_key, null_safe_match

# What Spark says of a table whose format has no row-level operations.
NO_MERGE = "UNSUPPORTED_FEATURE.TABLE_OPERATION"


def target_key_set(target: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Distinct target keys.  The distinct combines before its shuffle and leaves the rows placed for the join."""
    present = target.select(*keys)
    return (present if null_safe else present.dropna(subset=list(keys))).distinct()


def rows_to_insert(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    prune_by: str | None = None,
) -> DataFrame:
    """Source rows, one per key, whose key the target lacks.

    As in an equality merge, a key with a null never matches, so such a row is inserted again on every run;
    ``null_safe`` lets nulls match.  ``prune_by`` names a target partition column that the key determines (the
    pickup date for a key with the pickup time): the target is then read only between the source's smallest and
    largest value of it.
    """
    candidates = first_per_key(source, keys)
    if prune_by is not None:
        low = source.agg(F.min(prune_by)).scalar()
        high = source.agg(F.max(prune_by)).scalar()
        target = target.filter(F.col(prune_by).between(low, high))
    known = target_key_set(target, keys, null_safe)
    if not null_safe:
        return candidates.join(known, list(keys), "left_anti")
    known = known.toDF(*[f"_k_{k}" for k in keys])
    return candidates.join(known, null_safe_match(candidates, known, keys, "_k_"), "left_anti")


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str], *, null_safe: bool = False) -> str:
    """Insert the source rows, one per key, whose key a catalog table lacks; returns the way taken.

    A table whose format can merge does it in one statement (``merge``), atomically and with new columns where the format
    evolves; for another one the missing rows are found by an anti join and appended (``append``), in its own columns.
    """
    spark = source.sparkSession
    equals = "<=>" if null_safe else "="
    match = " AND ".join(f"{table}.`{k}` {equals} _source.`{k}`" for k in keys)
    try:
        merge = first_per_key(source, keys).alias("_source").mergeInto(table, F.expr(match)).whenNotMatched().insertAll()
        merge.withSchemaEvolution().merge()
        return "merge"
    except PySparkException as refused:
        if refused.getCondition() != NO_MERGE:
            raise
    target = spark.table(table)
    fresh = align_to(rows_to_insert(source, target, keys, null_safe=null_safe), target.schema)
    fresh.select(*target.columns).write.mode("append").saveAsTable(table)
    return "append"
