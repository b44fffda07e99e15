"""Tables kept by month, whose months are replaced together in one step.

Rows lie in builds: a build is the folder of one job and holds the months that this
job made, a subfolder each. The manifest says which build each month is read from, and
by what mark of its source the month was made. A new manifest is a small table of its
own; it counts from the moment its job has left the success marker, and with it all
its months at once. A writer lost before that leaves a build that no manifest names and
the old months readable.

The marks tell which months have to be made again: those whose source has another
mark now, and those whose source is gone. A table derived from another monthly table
takes the builds of that one for marks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderloom.sources.files import COMPLETE, Folder

MONTH_KEY = "order_ym"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "month string, build int, mark string"
#: The build of a month that has no rows.
NO_ROWS = 0


class Month(NamedTuple):
    build: int
    mark: str


@dataclass(frozen=True)
class MonthlyTable:
    """A table under ``folder`` with the columns of ``schema``, kept by ``order_ym``."""

    spark: SparkSession
    folder: str
    schema: StructType

    @property
    def _manifests(self) -> Folder:
        return Folder(self.spark, f"{self.folder}/manifest")

    def version(self) -> int:
        """Number of the manifest in use; 0 if there is none yet."""
        return self._manifests.latest()

    def manifest(self, version: int | None = None) -> dict[str, Month]:
        """What each month is made of; empty without a manifest."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.folder}/manifest/v{version}").collect()
        return {r["month"]: Month(r["build"], r["mark"]) for r in rows}

    def marks(self) -> dict[str, str]:
        """For tables derived from this one: a mark of each month that has rows."""
        return {name: str(month.build) for name, month in self.manifest().items() if month.build != NO_ROWS}

    def stale(self, marks: Mapping[str, str]) -> list[str]:
        """Months that were made from other marks than these, or whose source is gone."""
        stored = self.manifest()
        made = {name: month.mark for name, month in stored.items()}
        return sorted(name for name in stored.keys() | marks.keys() if made.get(name) != marks.get(name))

    def month_path(self, name: str, build: int) -> str:
        return f"{self.folder}/build={build}/{MONTH_KEY}={name}"

    def month_paths(self) -> dict[str, str]:
        """Where the rows of each month are."""
        return {name: self.month_path(name, m.build) for name, m in self.manifest().items() if m.build != NO_ROWS}

    def read(self, months: Iterable[str] | None = None) -> DataFrame:
        """The rows of some months, or of all; other months' folders aren't even listed."""
        wanted = None if months is None else set(months)
        paths = [path for name, path in self.month_paths().items() if wanted is None or name in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields, StructField(MONTH_KEY, IntegerType())])
        frame = self.spark.read.schema(stored).option("basePath", self.folder).parquet(*paths)
        return frame.select(*self.schema.fieldNames())

    def replace(self, rows: DataFrame, marks: Mapping[str, str], months: Iterable[str] | None = None) -> int:
        """Put ``rows`` (the columns and ``order_ym``) in the place of some months, or of all.

        ``marks`` has the source's mark of every month that it still has. Returns how many
        rows were written.
        """
        stored, version = self.manifest(), self.version()
        replaced = set(stored) | set(marks) if months is None else set(months)
        folder = Folder(self.spark, self.folder)
        build = max(folder.versions("build="), default=NO_ROWS) + 1
        written = Observation("rows")
        path = f"{self.folder}/build={build}"
        counted = rows.select(*self.schema.fieldNames(), MONTH_KEY).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(MONTH_KEY).parquet(path)
        made = {name.partition("=")[2] for name in Folder(self.spark, path).folders()}
        if strangers := sorted(made - (replaced & set(marks))):
            folder.remove(f"build={build}")
            raise ValueError(f"rows of months that were not to be replaced: {strangers}")
        now = {name: month for name, month in stored.items() if name not in replaced}
        now |= {name: Month(build if name in made else NO_ROWS, marks[name]) for name in replaced if name in marks}
        self._commit(now, version)
        return written.get["rows"]

    def _commit(self, months: dict[str, Month], before: int) -> None:
        rows = self.spark.createDataFrame([(name, *month) for name, month in sorted(months.items())], _MANIFEST)
        number = max(self._manifests.versions(), default=0) + 1
        rows.coalesce(1).write.parquet(f"{self.folder}/manifest/v{number}")
        self._manifests.keep_from(number)
        # Readers may hold the manifest before: its builds stay until the next commit.
        named = {m.build for m in months.values()} | {m.build for m in self.manifest(before).values()}
        folder = Folder(self.spark, self.folder)
        for build in folder.versions("build="):
            if build not in named:
                folder.remove(f"build={build}")


def complete_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders in ``path`` that a finished job has left."""
    return [found.rpartition("/")[0] for found in Folder(spark, path).matching(f"{prefix}*/{COMPLETE}")]
