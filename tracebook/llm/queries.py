"""The queries of the operators on the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracebook.llm import (
    collocations, decontaminate, html_text, licenses, lines, merkle, mixing, packing, quality, secret_scan, simhash,
    spans, toxicity,
)
from tracebook.llm.common import fold, table
from tracebook.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.drop_repeated(docs, window=35).drop("kept")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"), limit=2, words_per_shingle=3)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=1)


@query
def op3_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_verdicts(table(spark, sf_dir, "documents"), host="source")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs, items, share=0.2, recall=0.99)


@query
def op5_toxicity_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, fold(F.col("doc_id"), 3) == 1, threshold=0.7)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality(docs, labels, fold(F.col("doc_id"), 5) == 0, per_class=4000, threshold=0.3)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.secrets(docs, secret_scan.fitted(docs))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), words=3, min_count=10, share_percent=50, top=2000)


@query
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


assert SQL.keys() <= QUERIES.keys()
