"""SQL names for the stored tables.

Session views last as long as the session; catalog tables stay, for other
sessions and tools, and are dropped without touching the files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from orderloom.operators.staging import stg_orders
from orderloom.plans.pipeline import MARTS, TABLES
from orderloom.schema import BRONZE, SILVER
from orderloom.sources.files import Folder
from orderloom.sources.lake import BATCH_KEY, BRONZE_TABLE, SILVER_TABLE, Lake
from orderloom.sources.monthly import MONTH_KEY

STAGING = "stg_orders"
STORED = (*TABLES, "gold_customer_spend_tiers", *MARTS)


def register_views(lake: Lake) -> None:
    """Every stored table, and staging as a view over silver."""
    lake.register_views(STORED)
    stg_orders(lake.silver()).createOrReplaceTempView(STAGING)


def unregister_views(lake: Lake) -> None:
    lake.unregister_views((*STORED, STAGING))


def publish(lake: Lake, database: str) -> None:
    """Point catalog tables of ``database`` at the stored tables.

    A table that is there stays there: its location moves to the version in use in one
    step, so readers find the old rows or the new ones and never no table. Bronze and
    silver move partition by partition, each in one step; new partitions come before
    old ones go.
    """
    spark = lake.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in STORED:
        table = f"{database}.{name}"
        if name == BRONZE_TABLE:
            path = lake.path(name)
            found = Folder(spark, path).matching(f"{BATCH_KEY}=*/{MONTH_KEY}=*")
            batches = set(lake.bronze_batches())
            places = {month: f"{path}/{month}" for month in found if month.split("/")[0] in batches}
            _publish_partitions(spark, table, BRONZE, [BATCH_KEY, MONTH_KEY], lake.folder(name), places)
        elif name == SILVER_TABLE:
            months = lake.silver_months.month_paths()
            places = {f"{MONTH_KEY}={month}": path for month, path in months.items()}
            _publish_partitions(spark, table, SILVER, [MONTH_KEY], lake.folder(name), places)
        elif spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(lake.path(name))}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=lake.path(name), source="parquet")


def _publish_partitions(
    spark: SparkSession, table: str, schema: StructType, keys: list[str], folder: str, places: dict[str, str]
) -> None:
    """Give ``table`` the partitions of ``places`` (``key=value/key=value`` to path), and no others."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    partition_columns = ", ".join(f"{key} STRING" for key in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partition_columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{_quoted(folder)}'"
    )
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for place, path in places.items():
        change = "PARTITION ({0}) SET LOCATION" if place in there else "ADD IF NOT EXISTS PARTITION ({0}) LOCATION"
        spark.sql(f"ALTER TABLE {table} {change.format(_partition(place))} '{_quoted(path)}'")
    for place in sorted(there - places.keys()):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_partition(place)})")
    spark.catalog.refreshTable(table)


def _partition(place: str) -> str:
    return ", ".join("{} = '{}'".format(*part.partition("=")[::2]) for part in place.split("/"))


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def withdraw(lake: Lake, database: str) -> None:
    """Drop the catalog tables again; the files stay."""
    for name in STORED:
        lake.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
