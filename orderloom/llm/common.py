"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows that a Python worker gets at once where rows hold whole texts.
TEXTS_PER_BATCH = 500
_ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXTS_PER_BATCH) -> Iterator[None]:
    """Jobs inside hand at most ``rows`` rows at once to Python workers, which bounds both sides' buffers."""
    before = spark.conf.get(_ROWS_PER_BATCH)
    spark.conf.set(_ROWS_PER_BATCH, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS_PER_BATCH, before)


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared folder, ``spark.checkpoint.dir``.

    Only a session without that setting, as in tests, gets a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="orderloom-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and cut from its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet in the checkpoint folder and read again, so that its size is known."""
    path = f"{checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
