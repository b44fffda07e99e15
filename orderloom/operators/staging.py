"""Staging view over silver: surrogate key plus the columns marts use."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.functions.keys import surrogate_key
from orderloom.schema import SILVER


def stg_orders(silver: DataFrame) -> DataFrame:
    """A projection only, so Catalyst folds it into whatever reads it."""
    present = set(silver.columns)
    columns = [name for name in SILVER.fieldNames() if name in present]
    return silver.selectExpr(f"{surrogate_key('order_id')} AS order_sk", *columns)
