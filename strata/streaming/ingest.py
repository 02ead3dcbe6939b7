"""Incremental ingest as a stream over an arriving-files directory.

The stream finds the new files; each micro-batch reads them as a batch load does (by column name, whatever their
headers) and goes through the same checks, preparation and append.  It shares the register of loaded files with the batch jobs, so a file loaded by one is not loaded again by
the other, and a micro-batch that is replayed after a driver restart skips the files it had already registered.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import DEFAULT_DIRECTORY, load_dataset
from strata.lake import Lake
from strata.plans.bronze import load_update_files, registered_files, settle_loads
from strata.plans.runs import record_run
from strata.sources.files import literal, not_yet_ingested

# The binary-file source lists files; its content column is never selected, so no file is opened by the stream.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, source: str, files_per_batch: int) -> DataFrame:
    """Stream of the files that arrive: path, size and time as the batch listing has them."""
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(literal(source))
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    )


def ingest_stream(
    spark: SparkSession,
    lake: Lake,
    name: str,
    source: str,
    *,
    files_per_batch: int = 1000,
    config_dir: Path | str = DEFAULT_DIRECTORY,
) -> int:
    """Load everything that has arrived and stop; returns the rows appended."""
    cfg = load_dataset(name, config_dir)
    appended = []

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        settle_loads(session, lake, cfg)
        fresh = not_yet_ingested(batch, registered_files(session, lake, cfg)).collect()
        if not fresh:
            return
        with record_run(session, lake, "bronze", name, cfg.schema_version) as run:
            appended.append(load_update_files(session, lake, cfg, fresh, run))

    query = (
        arriving_files(spark, source, files_per_batch)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", lake.staging(f"checkpoints/{name}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(appended)
