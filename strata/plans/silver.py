"""Bronze tables to silver tables and rejects."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import DEFAULT_DIRECTORY, list_datasets, load_dataset
from strata.functions.names import with_safe_columns
from strata.functions.types import align_to
from strata.lake import Lake
from strata.operators.rules import ValidationResult, quality_rules, run_row_checks
from strata.operators.transforms import prepare, to_silver
from strata.operators.upsert import rows_to_insert
from strata.plans.bronze import read_update
from strata.plans.concurrent import side_by_side
from strata.plans.runs import record_run
from strata.sources.files import apply_filter
from strata.sources.tables import cluster_for_write, read_table, remove_table, table_exists, write_table


def _write_counted(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, mode: str = "overwrite", cluster: bool = True
) -> int:
    """Write and count in one pass; the count sits above the last shuffle."""
    counted = Observation()
    framed = (cluster_for_write(df, partition_by) if cluster else df).observe(counted, F.count(F.lit(1)).alias("rows"))
    write_table(framed, path, partition_by, mode=mode, cluster=False)
    return counted.get["rows"]


def _write_rejects(rejects: DataFrame, lake: Lake, table: str, mode: str) -> int:
    """Quarantine with the time of rejection; appended rows take the types of the existing quarantine."""
    spark, path = rejects.sparkSession, lake.rejects(table)
    stamped = rejects.withColumn("_rejected_at", F.current_timestamp())
    if mode == "append" and table_exists(spark, path):
        stamped = align_to(stamped, read_table(spark, path).schema)
    return _write_counted(stamped, path, mode=mode)


def _write_both(
    result: ValidationResult,
    lake: Lake,
    table: str,
    partition_by: Sequence[str],
    *,
    rejects_mode: str = "overwrite",
    cluster: bool = True,
) -> tuple[int, int]:
    written = side_by_side(
        result.good_df.sparkSession,
        {
            "kept": lambda: _write_counted(result.good_df, lake.silver(table), partition_by, cluster=cluster),
            "rejected": lambda: _write_rejects(result.rejects_df, lake, table, rejects_mode),
        },
    )
    return written["kept"], written["rejected"]


def promote_dataset(
    spark: SparkSession, lake: Lake, name: str, *, config_dir: Path | str = DEFAULT_DIRECTORY
) -> tuple[int, int]:
    """Standardise, check, and write good rows and rejects; returns (kept, rejected).

    The two outputs are two plans over the bronze scan.  Each is filtered at the scan, which is cheaper at scale
    than caching or staging the wide flagged frame between them, and both agree row by row because the choice
    among equal keys depends on content alone.  Good rows that come straight from a bronze table with the same
    partitions are already together by partition and are not shuffled again before the write.
    """
    cfg = load_dataset(name, config_dir)
    with record_run(spark, lake, "silver", name, cfg.schema_version) as run:
        bronze = read_table(spark, lake.bronze(cfg.bronze.table))
        table, partition_by = cfg.silver.table, cfg.silver.partition_by

        def stage(repeated: DataFrame) -> DataFrame:
            path = write_table(repeated, lake.staging(f"{table}_repeated_keys-{run.known['run_id']}"))
            return read_table(spark, path)

        checked = run_row_checks(to_silver(bronze, name), cfg.silver.validation, stage=stage, cluster_by=partition_by)
        cluster = checked.stats["shuffled"] or not set(partition_by) <= set(cfg.bronze.partition_by)
        kept, rejected = _write_both(checked, lake, table, partition_by, cluster=cluster)
        run.set_counts(
            processed=kept + rejected,
            inserted=kept,
            rejected=rejected,
            validation_failures=rejected,
            validation_ok=rejected == 0,
        )
        return kept, rejected


def promote_all(
    spark: SparkSession,
    lake: Lake,
    datasets: Iterable[str] | None = None,
    *,
    config_dir: Path | str = DEFAULT_DIRECTORY,
) -> dict[str, tuple[int, int]]:
    names = list(datasets) if datasets is not None else list_datasets(config_dir)
    return side_by_side(spark, {n: lambda n=n: promote_dataset(spark, lake, n, config_dir=config_dir) for n in names})


def promote_frame(
    df: DataFrame, lake: Lake, table: str, primary_key: Sequence[str], partition_by: Sequence[str] = (), **quality: Any
) -> tuple[int, int]:
    """Promote a prepared frame with the keyword form of the quality rules; rejects are appended."""
    rules = quality_rules(**quality) + [{"rule": "primary_key", "columns": list(primary_key)}]
    return _write_both(run_row_checks(df, rules), lake, table, partition_by, rejects_mode="append")


def merge_frame(
    update: DataFrame,
    lake: Lake,
    table: str,
    primary_key: Sequence[str],
    partition_by: Sequence[str] = (),
    rules: Any = (),
    *,
    prune_by: str | None = None,
    null_safe: bool = False,
) -> tuple[int, int]:
    """Insert the good update rows whose key the silver table lacks; returns (inserted, rejected).

    Rejects are appended and repeated keys inside the update are dropped.  New columns extend the table.
    """
    spark = update.sparkSession
    # Read once: the update is asked for its good rows, its rejects, its days and its count.
    staging = lake.staging(f"update-{uuid.uuid4().hex}")
    update = read_table(spark, write_table(update, staging, cluster=False))
    checked = run_row_checks(update, rules)
    target = read_table(spark, lake.silver(table))
    source = align_to(checked.good_df, target.schema)
    key = [c for c in primary_key if c in source.columns]
    fresh = rows_to_insert(source, target, key, null_safe=null_safe, prune_by=prune_by)
    inserted = _write_counted(fresh, lake.silver(table), partition_by, mode="append")
    # Last, as it is the step that a second run would repeat: rows that are inserted are known then.
    rejected = 0 if checked.rejects_df.isEmpty() else _write_rejects(checked.rejects_df, lake, table, "append")
    remove_table(spark, staging)
    return inserted, rejected


def merge_to_silver(
    update: DataFrame,
    lake: Lake,
    table: str,
    primary_key: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    prune_by: str | None = None,
    null_safe: bool = False,
    **quality: Any,
) -> tuple[int, int]:
    """``merge_frame`` with the keyword form of the quality rules."""
    rules = quality_rules(**quality)
    return merge_frame(update, lake, table, primary_key, partition_by, rules, prune_by=prune_by, null_safe=null_safe)


def merge_dataset_update(
    spark: SparkSession, lake: Lake, name: str, *, config_dir: Path | str = DEFAULT_DIRECTORY
) -> tuple[int, int]:
    """Bring a dataset's update file straight into silver; returns (inserted, rejected).

    The work follows the size of the update: of the target only the key columns are read, and only the partitions
    between the update's first and last day where the configuration says that the key determines the partition.
    """
    cfg = load_dataset(name, config_dir)
    with record_run(spark, lake, "silver", name, cfg.schema_version) as run:
        raw = apply_filter(read_update(spark, lake, cfg), cfg.bronze.filter)
        prepared = prepare(raw, cfg.bronze.prep, cfg.bronze.options)
        update = to_silver(with_safe_columns(prepared), name)
        rules = [r for r in cfg.silver.validation if r.get("rule") != "primary_key"]
        determined = cfg.silver.options.get("key_determines_partition") and cfg.silver.partition_by
        processed = update.count()
        inserted, rejected = merge_frame(
            update, lake, cfg.silver.table, cfg.silver.primary_key, cfg.silver.partition_by, rules,
            prune_by=cfg.silver.partition_by[0] if determined else None,
        )
        run.set_counts(
            processed=processed, inserted=inserted, rejected=rejected, validation_failures=rejected,
            validation_ok=rejected == 0,
        )
        return inserted, rejected
