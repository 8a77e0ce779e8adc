"""A corpus cleaning pipeline: each stage reads the documents that the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from storecast.llm import decontaminate, jaccard, language, packing, pii
from storecast.llm.tables import read, staged

#: What a task holds of its rows at once. Spark's own limits are 64 MB to a Python worker and 4,096
#: rows from a file, whatever their length; a task holds a batch several times over, on both sides
#: of the worker's pipe, and its process keeps much of that memory for the rest of the job.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.parquet.columnarReaderBatchSize": "1024"}
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, in a session that hands on rows by `BATCHES`. They stay set after it, as its
    result is computed later."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null or letterless text, or a text far from every profile."""
    return language.keep_identified(docs)


@in_small_batches
def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each class of documents with a Jaccard index of 0.8 or more."""
    return jaccard.keep_one(docs)


@in_small_batches
def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


@in_small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the name of its kind."""
    return pii.redact(docs)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its place in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", join_near_copies),
    ("decontaminate", remove_leaks),
    ("personal_data", redact_personal_data),
    ("pack", pack_sequences),
]

#: Boosted trees and best-fit packing have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    before = {key: spark.conf.get(key) for key in BATCHES}
    try:
        for name, stage in STAGES:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return docs
