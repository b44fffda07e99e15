"""The corpus pipeline: raw documents to packed sequences in five stages.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bin_packing, mixing, quality_classifier, secret_scan, simhash
from orderloom.llm.common import checkpoint_folder, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, fitted on this stage's input."""
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that of the smallest doc_id."""
    return simhash.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return bin_packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The first stage's model and the fingerprints have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, start=1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
