"""The daily load as a file stream.

New Parquet files in a landing folder are taken once each and appended to bronze
above its watermark. One start handles what is there and stops, so the job can
be scheduled like the batch load.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderloom.operators.incremental import load_bronze
from orderloom.schema import BRONZE
from orderloom.sources.files import Folder
from orderloom.sources.lake import Lake


def checkpoint_folder(spark: SparkSession, lake: Lake) -> str:
    """Progress is kept in the cluster's shared checkpoint folder if it names
    one (a subfolder per lake), else beside the tables."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return lake.folder("_bronze_stream")
    return f"{shared.rstrip('/')}/bronze_stream_{hashlib.md5(lake.base.encode()).hexdigest()}"


def landing_schema(spark: SparkSession, landing: str) -> StructType:
    """The layout of the files that are there; bronze's if there are none yet."""
    if not Folder(spark, landing).has(""):
        return BRONZE
    try:
        return spark.read.parquet(landing).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return BRONZE
        raise


def stream_id(spark: SparkSession, progress: str) -> str:
    """The id that a stream keeps in its checkpoint; another one if the checkpoint is made anew."""
    return json.loads(spark.read.text(f"{progress}/metadata").first()[0])["id"]


def load_new_files(
    lake: Lake,
    landing: str,
    checkpoint: str | None = None,
    load: str = "incremental",
    schema: StructType | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start the stream over ``landing``; await the returned query.

    ``load`` is ``incremental`` (rows above the watermark, as in the batch load) or
    ``append``: all rows of each new file, also those of days that bronze holds
    already, which suits files that share a day. ``schema`` is the files' own layout, by
    default that of the files there. ``partitions`` sets the session's shuffle partitions
    for the batches.

    A micro-batch is loaded under the stream's own id, which its checkpoint keeps, and its
    number: one that is repeated after a failure adds nothing, in either mode, so each
    file counts once. All files present at the start form one batch: the watermark must
    not rise between files that arrive together and hold the same day.
    """
    spark = lake.spark
    progress = checkpoint or checkpoint_folder(spark, lake)

    def append(batch: DataFrame, batch_id: int) -> None:
        if partitions:
            batch.sparkSession.conf.set("spark.sql.shuffle.partitions", partitions)
        load_bronze(lake, batch, load, f"{stream_id(spark, progress)}-{batch_id}")

    return (
        spark.readStream.schema(schema or landing_schema(spark, landing))
        .parquet(landing)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
