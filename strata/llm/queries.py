"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    common,
    contamination,
    huffman,
    licenses,
    main_text,
    near_duplicates,
    packing,
    personal_data,
    quality,
    repeated_passages,
    spelling,
    toxicity,
    url_filter,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(common.read_table(spark, sf_dir, "documents"))


@query("op9_token_id_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.scratch_path(spark, "huffman")
    huffman.write_ids(common.read_table(spark, sf_dir, "documents"), path)
    return huffman.read_ids(spark, path)


@query("op10_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(common.read_table(spark, sf_dir, "documents"))


@query("op7_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (common.read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination.verdicts(docs, benchmark)


@query("op8_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.groups(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op1_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.scores(docs, labels)


@query("op3_personal_data")
def personal_data_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(common.read_table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(common.read_table(spark, sf_dir, "pages"))


@query("op4_url_filters", url_filter.oracle_sql())
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(common.read_table(spark, sf_dir, "pages"))


@query("op6_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.read_table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(common.read_table(spark, sf_dir, "embeddings"))


@query("op13_substring_dedup", repeated_passages.oracle_sql())
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.verdicts(common.read_table(spark, sf_dir, "documents"))


@query("op12_spelling_variants", spelling.oracle_sql())
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(common.read_table(spark, sf_dir, "documents"))
