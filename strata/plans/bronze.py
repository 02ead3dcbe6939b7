"""Raw files to bronze tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from pathlib import Path
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import DEFAULT_DIRECTORY, DatasetConfig, list_datasets, load_dataset
from strata.lake import Lake
from strata.operators.rules import run_schema_checks
from strata.operators.transforms import prepare
from strata.plans.concurrent import side_by_side
from strata.plans.runs import Run, record_run
from strata.sources.files import (
    MALFORMED, SOURCE_FILE, apply_filter, list_files, literal, not_yet_ingested, path_exists, read_files, union_update,
)
from strata.sources.tables import (
    child_names, cluster_for_write, current_path, file_system, prepare_bronze, read_table, remove_table, table_exists, write_note,
    write_table,
)

# Fixed layout of the register of loaded files.
REGISTER_SCHEMA = "dataset string, path string, size bigint, modified_ms bigint"

# The partition column of bronze tables that names the load of a row.
LOAD_COLUMN = "_load"

IngestMode = Literal["auto", "full", "incremental"]


def update_path(spark: SparkSession, lake: Lake, cfg: DatasetConfig) -> str | None:
    """The dataset's update file or directory, if there is data in it."""
    if cfg.update_path is None:
        return None
    path = lake.raw(cfg.update_path)
    return path if path_exists(spark, path, with_data=True) else None


def resolve_mode(spark: SparkSession, lake: Lake, cfg: DatasetConfig, mode: IngestMode) -> IngestMode:
    """``auto`` appends when there is an update and a table to append to, else rewrites."""
    if mode != "auto":
        return mode
    has_update = update_path(spark, lake, cfg) is not None
    return "incremental" if has_update and table_exists(spark, lake.bronze(cfg.bronze.table)) else "full"


def read_raw_files(spark: SparkSession, cfg: DatasetConfig, paths, *, keep_malformed: bool = False) -> DataFrame:
    keep = keep_malformed and cfg.format == "csv" and not cfg.infer_schema
    return read_files(spark, paths, cfg.format, cfg.read, expected=cfg.expected, infer=cfg.infer_schema, keep_malformed=keep)


def read_raw(
    spark: SparkSession, lake: Lake, cfg: DatasetConfig, update_files: Sequence[str] | None = None, *, keep_malformed: bool = False
) -> DataFrame:
    """Base rows, and the update rows if there are any: of the files named, or of all there are."""
    base = read_raw_files(spark, cfg, lake.raw(cfg.path), keep_malformed=keep_malformed)
    update = update_path(spark, lake, cfg) if update_files is None else list(update_files)
    if not update:
        return base
    expected = cfg.expected if cfg.format == "csv" and not cfg.infer_schema else None
    return union_update(base, read_raw_files(spark, cfg, update, keep_malformed=keep_malformed), expected)


def read_update(spark: SparkSession, lake: Lake, cfg: DatasetConfig) -> DataFrame:
    """Update rows only."""
    path = update_path(spark, lake, cfg)
    if path is None:
        raise FileNotFoundError(f"{cfg.name} has no update data below {cfg.update_path}")
    return read_raw_files(spark, cfg, path)


def new_update_files(spark: SparkSession, lake: Lake, cfg: DatasetConfig) -> DataFrame:
    """Listing of the update files that the register does not hold in this version."""
    path = update_path(spark, lake, cfg)
    if path is None:
        raise FileNotFoundError(f"{cfg.name} has no update data below {cfg.update_path}")
    return not_yet_ingested(list_files(spark, path), registered_files(spark, lake, cfg))


# --- loads ----------------------------------------------------------------------------------------------------------
#
# A load has an id.  Its files are noted as an intent before anything is written, and its rows go to partition directories
# of that id.  Renaming the note into the register is what makes the load done; a note that is still an intent later belongs
# to a load that did not get to its end.


def intent_path(lake: Lake, cfg: DatasetConfig, load: str) -> str:
    return f"{lake.load_intents}/{cfg.name}/{load}.json"


def begin_load(spark: SparkSession, lake: Lake, cfg: DatasetConfig, files: Sequence, *, append: bool) -> str:
    """Note the files (path, size, time), whose names were needed to build the scan, as one line each."""
    load = f"{'append' if append else 'full'}-{uuid.uuid4().hex}"
    if files:
        rows = [{"dataset": cfg.name, "path": f["path"], "size": f["size"], "modified_ms": round(f["modified_at"].timestamp() * 1000)} for f in files]
        write_note(spark, intent_path(lake, cfg, load), "\n".join(map(json.dumps, rows)))
    return load


def finish_load(spark: SparkSession, lake: Lake, cfg: DatasetConfig, load: str, files: Sequence) -> None:
    """Register the files, in a note of this load alone, so that jobs of other processes cannot interfere."""
    if files:
        register_load(spark, lake, cfg, load)


def register_load(spark: SparkSession, lake: Lake, cfg: DatasetConfig, load: str) -> None:
    fs, intent = file_system(spark, intent_path(lake, cfg, load))
    _, registered = file_system(spark, f"{lake.ingested_files}/{load}.json")
    fs.mkdirs(registered.getParent())
    if not fs.rename(intent, registered):
        raise RuntimeError(f"{cfg.name}: the files of load {load} could not be registered")


def load_directories(spark: SparkSession, lake: Lake, cfg: DatasetConfig, load: str) -> list[str]:
    """Where the rows of a load are, in the table and in its quarantine."""
    tables = (lake.bronze(cfg.bronze.table), lake.malformed(cfg.bronze.table))
    there = [f"{current_path(spark, t)}/{LOAD_COLUMN}={load}" for t in tables]
    return [path for path in there if path_exists(spark, path)]


def settle_loads(spark: SparkSession, lake: Lake, cfg: DatasetConfig) -> None:
    """Bring loads that did not get to their end to a defined state; called before every load.

    A full load became the table in one step: if it did, its files are registered, else nothing of it is left.  What an
    append has written is removed, whole or not, and its files are new again.
    """
    for name in sorted(child_names(spark, f"{lake.load_intents}/{cfg.name}")):
        load = name.removesuffix(".json")
        written = load_directories(spark, lake, cfg, load)
        if written and load.startswith("full"):
            register_load(spark, lake, cfg, load)
            continue
        for path in written:
            remove_table(spark, path)
        remove_table(spark, intent_path(lake, cfg, load))


def registered_files(spark: SparkSession, lake: Lake, cfg: DatasetConfig) -> DataFrame | None:
    if not table_exists(spark, lake.ingested_files):
        return None
    register = spark.read.schema(REGISTER_SCHEMA).json(literal(lake.ingested_files))
    at = F.timestamp_millis("modified_ms").alias("modified_at")
    return register.filter(F.col("dataset") == cfg.name).select("dataset", "path", "size", at)


def keep_malformed_lines(spark: SparkSession, lake: Lake, cfg: DatasetConfig, lines: DataFrame, load: str, *, append: bool) -> int:
    """Write lines that do not fit their header to the quarantine of the table, with what was made of them; returns how many."""
    counted = Observation()
    parsed = [F.col(f"`{c}`") for c in lines.columns if c not in (MALFORMED, SOURCE_FILE)]
    rejects = lines.select(
        F.col(MALFORMED).alias("line"), F.to_json(F.struct(*parsed)).alias("parsed"), F.lit("malformed:fields").alias("_reject_reason"), F.col(SOURCE_FILE).alias("_source_file"),
        F.current_timestamp().alias("_rejected_at"), F.lit(load).alias(LOAD_COLUMN),
    )
    write_table(
        rejects.observe(counted, F.count(F.lit(1)).alias("rows")), lake.malformed(cfg.bronze.table), [LOAD_COLUMN],
        mode="append" if append else "overwrite", cluster=False,
    )
    return counted.get["rows"]


def load_frame(
    spark: SparkSession, lake: Lake, cfg: DatasetConfig, raw: DataFrame, run: Run, *, append: bool, load: str | None = None
) -> int:
    """Check the schema, filter, prepare and write one frame of raw rows; returns the rows written.

    Lines that do not fit their header go to the table's quarantine.  They are looked for in a second pass, which is
    made only if the first one has met any.
    """
    target, load = lake.bronze(cfg.bronze.table), load or f"append-{uuid.uuid4().hex}"
    lines, met = raw, Observation()
    if MALFORMED in raw.columns:
        raw = raw.observe(met, F.count(MALFORMED).alias("malformed")).filter(F.col(MALFORMED).isNull()).drop(MALFORMED, SOURCE_FILE)
    checked = run_schema_checks(raw, cfg.bronze.validation, cfg.name)
    if not checked.ok:
        run.set_counts(
            processed=0, inserted=0, rejected=0, validation_failures=len(checked.errors), validation_ok=False
        )
        run.explain("; ".join(checked.errors))
        raise ValueError(f"Schema validation failed for {cfg.name}: {list(checked.errors)}")
    framed = prepare(apply_filter(raw, cfg.bronze.filter), cfg.bronze.prep, cfg.bronze.options)
    schema = read_table(spark, target).schema if append and table_exists(spark, target) else None
    framed = cluster_for_write(prepare_bronze(framed, schema), cfg.bronze.partition_by)
    parts = list(cfg.bronze.partition_by)
    # A table from before loads had directories of their own keeps its layout until it is rewritten.
    if schema is None or LOAD_COLUMN in schema.names:
        framed, parts = framed.withColumn(LOAD_COLUMN, F.lit(load)), [LOAD_COLUMN, *parts]
    # Counted in the writing stage itself, above the last shuffle, so a retried task is not counted twice.
    counted = Observation()
    write_table(
        framed.observe(counted, F.count(F.lit(1)).alias("rows")), target, parts, mode="append" if append else "overwrite", cluster=False,
    )
    rows, malformed = counted.get["rows"], 0
    if MALFORMED in lines.columns and met.get["malformed"]:
        malformed = keep_malformed_lines(spark, lake, cfg, lines.filter(F.col(MALFORMED).isNotNull()), load, append=append)
    elif not append:
        remove_table(spark, lake.malformed(cfg.bronze.table))
    run.loaded(rows)
    if malformed:
        run.set_counts(processed=rows + malformed, rejected=malformed, validation_failures=malformed, validation_ok=False)
    return rows


def load_update_files(spark: SparkSession, lake: Lake, cfg: DatasetConfig, files: Sequence, run: Run) -> int:
    """Append the rows of update files (path, size, time) once, whatever becomes of this driver."""
    load = begin_load(spark, lake, cfg, files, append=True)
    raw = read_raw_files(spark, cfg, [f["path"] for f in files], keep_malformed=True)
    rows = load_frame(spark, lake, cfg, raw, run, append=True, load=load)
    finish_load(spark, lake, cfg, load, files)
    return rows


def load_everything(spark: SparkSession, lake: Lake, cfg: DatasetConfig, run: Run) -> int:
    """Rewrite the table from the base and from the update files that are there at the start, and no others."""
    update = update_path(spark, lake, cfg)
    files = list_files(spark, update).collect() if update else []
    load = begin_load(spark, lake, cfg, files, append=False)
    raw = read_raw(spark, lake, cfg, [f["path"] for f in files], keep_malformed=True)
    rows = load_frame(spark, lake, cfg, raw, run, append=False, load=load)
    finish_load(spark, lake, cfg, load, files)
    return rows


def ingest_dataset(
    spark: SparkSession,
    lake: Lake,
    name: str,
    *,
    mode: IngestMode = "auto",
    config_dir: Path | str = DEFAULT_DIRECTORY,
) -> int:
    """Load one dataset into bronze and return the number of rows written.

    A full load rewrites the table from base and update.  An incremental load appends only update files that
    were not loaded before: the register keeps path, size and modification time, so running it twice adds
    nothing, and an update file that was regenerated in place counts as new.
    """
    cfg = load_dataset(name, config_dir)
    with record_run(spark, lake, "bronze", name, cfg.schema_version) as run:
        settle_loads(spark, lake, cfg)
        if resolve_mode(spark, lake, cfg, mode) == "full":
            return load_everything(spark, lake, cfg, run)
        files = new_update_files(spark, lake, cfg).collect()
        if files:
            return load_update_files(spark, lake, cfg, files, run)
        run.loaded(0)
        return 0


def ingest_all(
    spark: SparkSession,
    lake: Lake,
    datasets: Iterable[str] | None = None,
    *,
    mode: IngestMode = "auto",
    config_dir: Path | str = DEFAULT_DIRECTORY,
) -> dict[str, int]:
    names = list(datasets) if datasets is not None else list_datasets(config_dir)
    return side_by_side(
        spark, {n: lambda n=n: ingest_dataset(spark, lake, n, mode=mode, config_dir=config_dir) for n in names}
    )
