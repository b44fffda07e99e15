"""Folders of the shared file system, through Spark's own Hadoop client."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Left by a job that has finished: what lies beside it is whole.
COMPLETE = "_SUCCESS"


class Folder:
    """One folder: what it lists. Nothing is read."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs
        self._path = self._hadoop.Path(path)
        self._fs = self._path.getFileSystem(context._jsc.hadoopConfiguration())

    def _child(self, name: str):
        return self._path.suffix(f"/{name}")

    def folders(self) -> list[str]:
        """Names of the folders in it; none if it doesn't exist."""
        if not self._fs.exists(self._path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isDirectory()]

    def matching(self, pattern: str) -> list[str]:
        """Paths below it that fit a glob, relative to it."""
        whole = self._fs.makeQualified(self._path).toString()
        escaped = re.sub(r"([\\{}\[\]*?])", r"\\\1", whole)
        found = self._fs.globStatus(self._hadoop.Path(f"{escaped}/{pattern}")) or []
        return sorted(s.getPath().toString()[len(whole) + 1 :] for s in found)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._child(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._child(name), True)

    def versions(self, prefix: str = "v") -> list[int]:
        """Numbers of the folders named by ``prefix`` and a number, rising."""
        names = (name[len(prefix) :] for name in self.folders() if name.startswith(prefix))
        return sorted(int(n) for n in names if n.isdigit())

    def latest(self) -> int:
        """The highest version that a finished job has left; 0 if there is none."""
        return next((v for v in reversed(self.versions()) if self.has(f"v{v}/{COMPLETE}")), 0)

    def keep_from(self, number: int) -> None:
        """Remove the versions before ``number``, but for the last finished one of them.

        Readers at work may still hold that one.
        """
        older = [v for v in self.versions() if v < number]
        kept = next((v for v in reversed(older) if self.has(f"v{v}/{COMPLETE}")), None)
        for v in older:
            if v != kept:
                self.remove(f"v{v}")


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length) of the Parquet files below a folder. Lists, reads nothing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "modificationTime", "length")


def file_marks(files: DataFrame, group: str) -> dict[str, str]:
    """Per value of a SQL expression over ``path``, a mark of its files' names, sizes and times.

    A file that is added, removed or replaced changes the mark, whatever its size.
    """
    one = F.xxhash64("path", "modificationTime", "length").cast("decimal(20, 0)")
    marks = files.groupBy(F.expr(group).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("sum"))
    return {r["name"]: f"{r['n']}:{r['sum']}" for r in marks.collect()}
