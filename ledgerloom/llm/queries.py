"""The registered queries of the operators, over whole tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    language_id, licenses, mixing, ngram_join, packing, periodic_runs, personal_data, quality, quality_classifier, sharding,
    spelling_variants, token_counts, vector_search,
)
from ledgerloom.llm.shared import documents
from ledgerloom.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op7_top_k_search": vector_search.ORACLE}


def _register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@_register
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(documents(spark, folder))
    return taken.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@_register
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


@_register
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder).select("doc_id", "text"))


@_register
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, folder))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@_register
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language_id.fit(language_id.training_sample(docs))
    rows = docs.select("doc_id", "text", language_id.held_out(F.col("doc_id")).alias("held_out"))
    return language_id.predict_language(rows, model)


@_register
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    ratios = quality.log_ratios(quality.trusted_documents(docs, load_table(spark, folder, "labels")), docs)
    return quality.judge_quality(docs, ratios)


@_register
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find_personal_data(documents(spark, folder).select("doc_id", "text"))


@_register
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, folder).select("doc_id", "text")).drop("text")


@_register
def op7_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    table = load_table(spark, folder, "embeddings")
    return vector_search.top_k(table, table.where(F.col("vec_id") % 50 == 0))


@_register
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_documents(documents(spark, folder))


@_register
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, folder).select("doc_id", "text")))
    digests = periodic_runs.digests(found)
    return found.select("doc_id", *[column.alias(name) for name, column in digests.items()])


@_register
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling_variants.with_slips(spelling_variants.letter_runs(documents(spark, folder)))
    return spelling_variants.spelling_variants(spelling_variants.word_counts(runs))


@_register
def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_classifier.classify_quality(documents(spark, folder), load_table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
