"""Mart tables over the staging view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.segments import segment_by_spend_and_frequency
from orderloom.operators import rollups


def daily_sales(staging: DataFrame) -> DataFrame:
    return rollups.by_day(staging)


def category_metrics(staging: DataFrame) -> DataFrame:
    return rollups.by_category(staging)


def city_metrics(staging: DataFrame) -> DataFrame:
    return rollups.by_city(staging)


def customer_segments(staging: DataFrame, as_of: date | None = None) -> DataFrame:
    """Recency, frequency and spend per customer with the two-threshold segment."""
    return customer_segments_columns(customer_rollup(staging, as_of))


def customer_rollup(staging: DataFrame, as_of: date | None = None) -> DataFrame:
    """All customer measures of the mart and of both gold customer tables."""
    return rollups.by_customer(staging, as_of, "avg_rating", "categories_bought")


def customer_segments_columns(customers: DataFrame) -> DataFrame:
    return with_segment(customers).drop("avg_order_value")


def with_segment(customers: DataFrame) -> DataFrame:
    return customers.withColumn("customer_segment", F.expr(segment_by_spend_and_frequency("monetary", "frequency")))
