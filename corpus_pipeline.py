"""The corpus pipeline: documents to packed training sequences, one stage per step."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, ngram_join, packing, personal_data, quality
from ledgerloom.llm.shared import documents
from ledgerloom.session import ensure_checkpoint_dir
from ledgerloom.sources.tables import load_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows sent to a Python worker at once.  Spark's 10 000 texts take tens of MB on either side.
BATCH_ROWS = 2500


def in_small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers at most ``BATCH_ROWS`` at a time, or fewer if the session says so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail them go."""
    in_small_batches(spark)
    trusted = quality.trusted_documents(docs, load_table(spark, sf_dir, "labels"))
    return quality.kept_documents(docs, quality.log_ratios(trusted, docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the one of lowest id stays."""
    in_small_batches(spark)
    return ngram_join.one_of_each_group(docs, percent=80, size=5)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span found is replaced by its kind."""
    in_small_batches(spark)
    return personal_data.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each source brought to its target, documents repeated or cut as it asks."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of documents in sequences of fixed length."""
    in_small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: hashed statistics, transitive groups and a tokenizer are beyond it.  Tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next one."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
