"""Raw files: format dispatch, typed reading, discovery, and what has not been ingested yet."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.types import align_to, cast_declared

SUPPORTED_SUFFIXES = (".csv", ".parquet")

#: Columns of a CSV frame for lines that do not fit their header.
MALFORMED, SOURCE_FILE = "_malformed_line", "_source_file"

#: Files whose header is asked for at the same time.
HEADERS_AT_ONCE = 32

# Fixed layout of a listing row.
LISTING_COLUMNS = ("path", "size", "modified_at")


def is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def literal(path: str) -> str:
    """The path as Spark's readers have to be given it to take it as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file that is not blank; no more is read than the reader buffers, however long the file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line or ""
    finally:
        stream.close()


def header_groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The paths as they are if all their files have one header line, else the files of each header.

    Spark applies one header to all files of a scan, by position.  The names, which Spark has on the driver to plan a
    scan, are asked for their first lines there, many at a time; of the files' contents nothing else is read.
    """
    if len(paths) == 1 and is_file(spark, paths[0]):
        return [list(paths)]
    names = sorted(unquote(name) for name in spark.read.text([literal(p) for p in paths]).inputFiles())
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for name, header in zip(names, pool.map(lambda name: first_line(spark, name), names), strict=True):
            groups.setdefault(header, []).append(name)
    # A file without any line has no rows either.
    groups.pop("", None)
    return list(groups.values()) if len(groups) > 1 else [list(paths)]


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], options: Mapping[str, Any] | None = None, *, infer: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """CSV with headers, files matched by column name.  Without inference every column is text.

    Names are taken as they are, whatever characters they hold; nothing is a pattern.  With ``keep_malformed`` a line
    with more or fewer fields than its header is kept whole in ``MALFORMED``, with its file in ``SOURCE_FILE``; both are
    null for all other lines.
    """
    options = dict(options or {})
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = options.get("header", True)
    groups = [paths] if str(header).lower() == "false" else header_groups(spark, paths)

    def read(group: Sequence[str]) -> DataFrame:
        names = [literal(p) for p in group]
        reading = {"header": header, "inferSchema": infer, "mode": options.get("mode", "PERMISSIVE")}
        plain = spark.read.options(**reading).csv(names)
        if not keep_malformed:
            return plain
        schema = T.StructType([*plain.schema.fields, T.StructField(MALFORMED, T.StringType())])
        lines = spark.read.options(columnNameOfCorruptRecord=MALFORMED, **reading).schema(schema).csv(names)
        return lines.withColumn(SOURCE_FILE, F.when(F.col(MALFORMED).isNotNull(), F.col("_metadata.file_path")))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(read, groups))


def read_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files or directories of these names, the schemas of all files merged."""
    return spark.read.option("mergeSchema", True).parquet(*map(literal, paths))


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    options: Mapping[str, Any] | None = None,
    *,
    expected: Mapping[str, str] | None = None,
    infer: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """Read a file, a directory or a list of either.  Text is cast to the declared types."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        return read_parquet(spark, paths)
    if fmt != "csv":
        return spark.read.format(fmt).options(**dict(options or {})).load([literal(p) for p in paths])
    df = read_csv(spark, paths, options, infer=infer, keep_malformed=keep_malformed)
    return cast_declared(df, expected) if expected and not infer else df


def union_update(base: DataFrame, update: DataFrame, expected: Mapping[str, str] | None = None) -> DataFrame:
    """Base and update rows by column name; columns only one side has are null on the other."""
    out = base.unionByName(update, allowMissingColumns=True)
    return cast_declared(out, expected) if expected else out


def apply_filter(df: DataFrame, declared: Mapping[str, Any] | None) -> DataFrame:
    """The declared equality filter; with none, or with no ``equals``, the frame is unchanged."""
    if not declared or "equals" not in declared:
        return df
    return df.filter(F.col(f"`{declared['column']}`") == F.lit(declared["equals"]))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file below the paths: path, size, modification time.

    The binary-file source lists without opening the files as long as the content column is not selected, so the
    listing is itself a distributed scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([literal(p) for p in paths])
        .select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    )


def path_exists(spark: SparkSession, path: str, *, with_data: bool = False) -> bool:
    """Ask the path's own file system; with ``with_data`` a directory has to hold more than bookkeeping entries."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not with_data or not fs.exists(target):
        return fs.exists(target)
    entries = fs.listStatusIterator(target)
    while entries.hasNext():
        if not entries.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def discover_files(spark: SparkSession, root: str, keywords: Iterable[str]) -> list[str]:
    """Supported files below ``root`` whose path contains one of the keywords, ignoring case, sorted.

    Only names come back to the driver, which needs them to build the scan.
    """
    keywords = tuple(keywords)
    path = F.lower(F.substring_index(F.col("path"), root.rstrip("/"), -1))
    wanted = reduce(lambda a, b: a | b, [path.contains(k.lower()) for k in keywords])
    suffix = reduce(lambda a, b: a | b, [path.endswith(s) for s in SUPPORTED_SUFFIXES])
    rows = list_files(spark, root).filter(wanted & suffix).select("path").orderBy("path").toLocalIterator()
    files = [r["path"] for r in rows]
    if not files:
        raise FileNotFoundError(f"{root} holds no CSV or Parquet file named after any of {', '.join(keywords)}; add one or change the keywords")
    return files


def read_mixed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV and Parquet files as one frame, matched by column name.

    Parquet files are one multi-path scan, and so are the CSV files of each header.  Text stays text (inference would
    cost a pass and would turn a clock time into a timestamp of today) unless Parquet has a type for the column.
    """
    parquet = [p for p in paths if p.lower().endswith(".parquet")]
    text = [p for p in paths if p.lower().endswith(".csv")]
    frames = [read_csv(spark, text)] if text else []
    if parquet:
        columnar = read_parquet(spark, parquet)
        frames = [columnar, *[align_to(f, columnar.schema) for f in frames]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def not_yet_ingested(listing: DataFrame, known: DataFrame | None) -> DataFrame:
    """Listed files that the register does not hold with the same path, size and modification time."""
    if known is None:
        return listing
    return listing.join(known.select(*LISTING_COLUMNS), list(LISTING_COLUMNS), "left_anti")
