"""Lake tables: partitioned Parquet directories with additive schema evolution.

An overwrite goes to a new directory inside the table's and becomes the table by the rename of one small file, whose
number is one above the last.  A reader sees the old rows or the new ones, and a frame that was opened before stays
readable until the overwrite after next.  An overwrite that is interrupted leaves the table as it was.  Two writers that
overwrite at once are told apart by the number: the second fails.  Appends go to the current directory; Spark's own
commit protocol covers lost tasks and executors.  A plain Parquet directory is a table too, until it is overwritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import with_safe_columns
from strata.functions.types import align_to
from strata.sources.files import literal, path_exists


# Name of the note beside the data files; Spark skips names that start with an underscore.
SCHEMA_NOTE = "_schema.json"
# Names of the switches inside a table: the directory of the pointers, each named by its number.
POINTERS = "_versions"
NUMBER_DIGITS = 12


class Version(NamedTuple):
    """The directory that holds a table's rows; number 0 is the table's own directory."""

    number: int
    path: str


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_note(spark: SparkSession, path: str) -> str:
    fs, note = file_system(spark, path)
    stream = fs.open(note)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    fs, note = file_system(spark, path)
    stream = fs.create(note, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; none if it does not exist."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    names, entries = [], fs.listStatusIterator(target)
    while entries.hasNext():
        names.append(entries.next().getPath().getName())
    return names


def current_version(spark: SparkSession, path: str) -> Version:
    """Where the table's rows are now."""
    pointers = [name for name in child_names(spark, f"{path}/{POINTERS}") if name.isdigit()]
    if not pointers:
        return Version(0, path)
    newest = max(pointers)
    return Version(int(newest), f"{path}/{read_note(spark, f'{path}/{POINTERS}/{newest}')}")


def current_path(spark: SparkSession, path: str) -> str:
    return current_version(spark, path).path


def switch_version(spark: SparkSession, path: str, number: int, directory: str) -> None:
    """Make ``directory`` the table's version ``number``, unless another writer has made one of that number."""
    fs, target = file_system(spark, f"{path}/{POINTERS}/{number:0{NUMBER_DIGITS}d}")
    written = f"{path}/{POINTERS}/.{uuid.uuid4().hex}"
    write_note(spark, written, directory)
    _, source = file_system(spark, written)
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, False)
        raise RuntimeError(f"{path} was overwritten by another writer meanwhile; run this job again")


def remove_old_versions(spark: SparkSession, path: str, kept: Sequence[str]) -> None:
    """Drop what is neither one of the ``kept`` directories nor a note: older versions and interrupted overwrites."""
    kept_names = {k.rsplit("/", 1)[-1] for k in kept}
    for name in child_names(spark, path):
        if name not in kept_names and name != POINTERS:
            remove_table(spark, f"{path}/{name}")
    pointers = sorted(name for name in child_names(spark, f"{path}/{POINTERS}") if name.isdigit())
    for name in pointers[: -len(kept)]:
        remove_table(spark, f"{path}/{POINTERS}/{name}")


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema noted by the last write to a version's directory, if there is one."""
    fs, note = file_system(spark, f"{path}/{SCHEMA_NOTE}")
    return T.StructType.fromJson(json.loads(read_note(spark, note.toString()))) if fs.exists(note) else None


def note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_note(spark, f"{path}/{SCHEMA_NOTE}", schema.json())


def read_table(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    """A table as it stands.

    The noted schema is used if there is one, so that a table of a million files is opened without reading their
    footers.  Without a note, or with ``merge_schema``, the schemas of all files are merged.
    """
    path = current_path(spark, path)
    schema = None if merge_schema else noted_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(literal(path))
    return spark.read.option("mergeSchema", True).parquet(literal(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the directory holds a readable table."""
    number, current = current_version(spark, path)
    return number > 0 or path_exists(spark, current, with_data=True)


def remove_table(spark: SparkSession, path: str) -> None:
    """Drop an intermediate table, or a folder of them, for good."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def as_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Register a table for SQL under a temporary name."""
    df = read_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def present_partitions(df: DataFrame, partition_by: Sequence[str] | None) -> list[str]:
    return [c for c in partition_by or [] if c in df.columns]


def cluster_for_write(df: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Bring the rows of a partition together before the write, to bound the number of files.

    The rebalance hint lets adaptive execution merge small partitions and split large ones, so a partition value
    that holds a third of the table still spreads over many tasks.
    """
    parts = present_partitions(df, partition_by)
    return df.hint("rebalance", *parts) if parts else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    *,
    mode: str = "overwrite",
    cluster: bool = True,
    dynamic: bool = False,
) -> str:
    """Write a table.  Overwriting replaces rows and schema at once; appending may bring new columns.

    ``dynamic`` replaces only the partitions that occur in ``df``.
    """
    parts = present_partitions(df, partition_by)
    out = cluster_for_write(df, parts) if cluster else df
    spark = df.sparkSession
    before = current_version(spark, path)
    there = before.number > 0 or path_exists(spark, path, with_data=True)
    if there and (mode == "append" or dynamic):
        # The note goes first: if the write then fails, a column without values does no harm.
        known = noted_schema(spark, before.path) or read_table(spark, path).schema
        added = [f for f in df.schema.fields if f.name not in known.names]
        if added:
            note_schema(spark, before.path, T.StructType([*known.fields, *added]))
        writer = out.write.mode(mode).partitionBy(*parts)
        (writer.option("partitionOverwriteMode", "dynamic") if dynamic else writer).parquet(before.path)
        return path
    number = before.number + 1
    directory = f"v{number:0{NUMBER_DIGITS}d}-{uuid.uuid4().hex}"
    out.write.partitionBy(*parts).parquet(f"{path}/{directory}")
    note_schema(spark, f"{path}/{directory}", df.schema)
    switch_version(spark, path, number, directory)
    if before.number:
        remove_old_versions(spark, path, (before.path, directory))
    return path


def prepare_bronze(df: DataFrame, existing_schema=None) -> DataFrame:
    """Safe column names, the ingest time, and on append the types of the existing table."""
    framed = with_safe_columns(df).withColumn("_ingested_at", F.current_timestamp())
    return framed if existing_schema is None else align_to(framed, existing_schema)


def preview(df: DataFrame, n: int = 3) -> tuple[int, list]:
    """Row count and the first few rows."""
    return df.count(), df.take(n)


def write_export(df: DataFrame, path: str) -> str:
    """Hand-over copy: a small result becomes one file, a large one as many as its size asks for."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    return path
