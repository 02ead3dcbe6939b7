"""A corpus from raw documents to packed sequences: quality, near duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import common, contamination, near_duplicates, packing, personal_data, quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_fit(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id."""
    return near_duplicates.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return contamination.remove_contaminated(docs, common.read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return personal_data.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_fit),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has no MinHash, no trained models and no tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is written before the next one reads it."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
