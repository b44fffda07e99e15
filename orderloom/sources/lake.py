"""Stored layer tables: Parquet folders under one base path.

The base path plays the part of a schema name: tests use their own.

Bronze is a folder of versions, one per ``replace``; a version is a folder of batches,
one per load. A batch is written by one job, laid out by ``order_ym`` (year * 100 +
month of the order date), and counts from the moment this job has left its success
marker. The batch folders are the log of what was loaded: a batch that comes again
under its id adds nothing, and what a lost attempt has left is written anew.

Silver and what is derived from it month by month are ``MonthlyTable``s. All other
tables are folders of versions too: a replacement is written to a new version, and
readers see either one whole. The version before stays for readers at work.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderloom.operators.cleaning import as_bronze
from orderloom.schema import BRONZE, SILVER
from orderloom.sources.files import COMPLETE, Folder, file_marks, parquet_files
from orderloom.sources.monthly import MONTH_KEY, NO_MONTH, MonthlyTable, complete_folders

BRONZE_TABLE = "bronze_orders"
SILVER_TABLE = "silver_orders"
BATCH_KEY = "batch"
STATE_TABLE = "build_state"

_STATE = "silver int, rows map<string, bigint>, as_of date"

_BRONZE_STORED = StructType(BRONZE.fields + [StructField(MONTH_KEY, IntegerType())])


def month_key(day: str) -> Column:
    return F.expr(f"year({day}) * 100 + month({day})").alias(MONTH_KEY)


@dataclass(frozen=True)
class Lake:
    """Named tables under ``base``."""

    spark: SparkSession
    base: str

    def folder(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def version(self, name: str) -> int:
        """The version in use; 0 if there is none yet."""
        return Folder(self.spark, self.folder(name)).latest()

    def path(self, name: str) -> str:
        """Where the version in use is, or the first one will be; silver's whole folder."""
        if name == SILVER_TABLE:
            return self.folder(name)
        return f"{self.folder(name)}/v{max(self.version(name), 1)}"

    # -- bronze ---------------------------------------------------------

    def ensure_bronze(self) -> None:
        """Create an empty bronze table unless there is one."""
        if not self.version(BRONZE_TABLE):
            self._open_bronze(self.path(BRONZE_TABLE))

    def _open_bronze(self, path: str) -> None:
        """Leave the marker by which a version counts."""
        self.spark.createDataFrame([], _BRONZE_STORED).write.mode("append").partitionBy(MONTH_KEY).parquet(path)

    def bronze(self) -> DataFrame:
        return self._bronze_stored().select(*BRONZE.fieldNames())

    def bronze_batches(self) -> list[str]:
        """Folders of the batches that were loaded whole."""
        return complete_folders(self.spark, self.path(BRONZE_TABLE), f"{BATCH_KEY}=")

    def bronze_months(self) -> list[str]:
        """Partition values of the months that have rows, from the folder listing alone."""
        batches = set(self.bronze_batches())
        found = Folder(self.spark, self.path(BRONZE_TABLE)).matching(f"{BATCH_KEY}=*/{MONTH_KEY}=*")
        months = (path.split("/") for path in found)
        return sorted({month.partition("=")[2] for batch, month in months if batch in batches})

    def bronze_marks(self) -> dict[str, str]:
        """Per month a mark that changes with its files, from their listing alone."""
        batches = [name.partition("=")[2] for name in self.bronze_batches()]
        if not batches:
            return {}
        files = parquet_files(self.spark, self.path(BRONZE_TABLE))
        batch = F.regexp_extract("path", f"/{BATCH_KEY}=([^/]+)/", 1)
        return file_marks(files.where(batch.isin(batches)), f"regexp_extract(path, '/{MONTH_KEY}=([^/]+)/', 1)")

    def bronze_of_months(self, months: Iterable[str]) -> DataFrame:
        """The bronze rows of some months; other months' files are pruned."""
        return self._bronze_stored().where(self.in_months(F.col(MONTH_KEY), months)).select(*BRONZE.fieldNames())

    @staticmethod
    def in_months(key: Column, months: Iterable[str]) -> Column:
        dated = [int(m) for m in months if m != NO_MONTH]
        inside = key.isin(dated) if dated else F.lit(False)
        return inside | key.isNull() if NO_MONTH in months else inside

    def bronze_watermark(self) -> date | None:
        """The highest stored order date; None if no row has one.

        Months come from the folder listing; the newest one that holds a date is the
        only one that is read.
        """
        for month in sorted((m for m in self.bronze_months() if m != NO_MONTH), key=int, reverse=True):
            found = self.bronze_of_months([month]).agg(F.max("order_date")).first()[0]
            if found is not None:
                return found
        return None

    def has_batch(self, batch_id: str) -> bool:
        return Folder(self.spark, self.path(BRONZE_TABLE)).has(f"{BATCH_KEY}={batch_id}/{COMPLETE}")

    def append_bronze(self, rows: DataFrame, batch_id: str | None = None) -> int:
        """Add a batch, matching columns by name; returns how many rows.

        0 if a batch of this id was added already. Without an id it is a batch of its own.
        """
        self.ensure_bronze()
        batch_id = batch_id or uuid.uuid4().hex
        if self.has_batch(batch_id):
            return 0
        return self._write_batch(rows, f"{self.path(BRONZE_TABLE)}/{BATCH_KEY}={batch_id}")

    def replace_bronze(self, rows: DataFrame, batch_id: str | None = None) -> int:
        """Drop what was loaded and store these rows instead, as the first batch of a new version."""
        folder = Folder(self.spark, self.folder(BRONZE_TABLE))
        number = max(folder.versions(), default=0) + 1
        path = f"{self.folder(BRONZE_TABLE)}/v{number}"
        loaded = self._write_batch(rows, f"{path}/{BATCH_KEY}={batch_id or uuid.uuid4().hex}")
        self._open_bronze(path)
        folder.keep_from(number)
        return loaded

    def _write_batch(self, rows: DataFrame, path: str) -> int:
        """The rebalance groups each month's rows into files of the advisory size
        and splits a month that is too large for one task."""
        laid_out = as_bronze(rows).withColumn(MONTH_KEY, month_key("order_date")).hint("rebalance", MONTH_KEY)
        return self._write(laid_out, path, [MONTH_KEY])

    def _bronze_stored(self) -> DataFrame:
        path = self.path(BRONZE_TABLE)
        batches = [f"{path}/{name}" for name in self.bronze_batches()]
        if not batches:
            return self.spark.createDataFrame([], _BRONZE_STORED)
        return self.spark.read.schema(_BRONZE_STORED).option("basePath", path).parquet(*batches)

    # -- silver ---------------------------------------------------------

    def monthly(self, name: str, schema: StructType) -> MonthlyTable:
        return MonthlyTable(self.spark, self.folder(name), schema)

    @property
    def silver_months(self) -> MonthlyTable:
        return self.monthly(SILVER_TABLE, SILVER)

    def replace_silver(self, rows: DataFrame, marks: Mapping[str, str], months: Iterable[str] | None = None) -> int:
        """Reload silver, or some of its months. No shuffle: bronze files hold one month
        each, so a task writes few partitions. ``marks`` are those of bronze."""
        return self.silver_months.replace(rows.withColumn(MONTH_KEY, month_key("order_date")), marks, months)

    def silver_of_months(self, months: Iterable[str]) -> DataFrame:
        return self.silver_months.read(months)

    def silver(self) -> DataFrame:
        return self.silver_months.read()

    def state(self) -> dict | None:
        """What the last finished build of the tables above silver was made from."""
        if not self.version(STATE_TABLE):
            return None
        return self.spark.read.schema(_STATE).parquet(self.path(STATE_TABLE)).first().asDict()

    def save_state(self, rows: dict[str, int], as_of: date) -> None:
        row = (self.silver_months.version(), rows, as_of)
        self.replace(STATE_TABLE, self.spark.createDataFrame([row], _STATE))

    # -- aggregate tables -----------------------------------------------

    def replace(self, name: str, rows: DataFrame) -> int:
        """Drop and recreate a table from a query."""
        folder = Folder(self.spark, self.folder(name))
        number = max(folder.versions(), default=0) + 1
        written = self._write(rows, f"{self.folder(name)}/v{number}")
        folder.keep_from(number)
        return written

    def table(self, name: str) -> DataFrame:
        if name == BRONZE_TABLE:
            return self.bronze()
        if name == SILVER_TABLE:
            return self.silver()
        return self.spark.read.parquet(self.path(name))

    def register_views(self, names: Iterable[str]) -> None:
        """Make the tables queryable by name in ``spark.sql``."""
        for name in names:
            self.table(name).createOrReplaceTempView(name)

    def unregister_views(self, names: Iterable[str]) -> None:
        for name in names:
            self.spark.catalog.dropTempView(name)

    # -- writing --------------------------------------------------------

    def _write(self, rows: DataFrame, path: str, partition_by: Iterable[str] = ()) -> int:
        # The count is taken by the write itself, in its last stage, where each
        # partition is counted once however often its task is retried. Files that a lost
        # attempt has left in the folder go.
        written = Observation("rows")
        writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer.partitionBy(*partition_by).parquet(path)
        return written.get["rows"]
