"""Sizes of stored folders, for setting the number of shuffle partitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderloom.sources.files import parquet_files

# A reducer's share of a shuffle about as wide as its input.
_BYTES_PER_PARTITION = 128 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total file size under a folder, 0 if there is none. Lists, reads nothing."""
    try:
        return parquet_files(spark, path).agg(F.expr("coalesce(sum(length), 0) AS total")).first()["total"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def shuffle_partitions(input_bytes: int, at_least: int) -> int:
    """Partitions for shuffles over an input of this size.

    Adaptive execution merges partitions that turn out small but cannot add any,
    so a shuffle has to start with enough of them.
    """
    return max(at_least, -(-input_bytes // _BYTES_PER_PARTITION))
