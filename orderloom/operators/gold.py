"""Gold tables over silver.

A gold table is the matching roll-up with fewer columns, some renamed. The
``*_columns`` functions do that selection, so a pipeline that has already stored
the roll-ups gets gold from them without aggregating silver again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from orderloom.functions.segments import segment_by_spend
from orderloom.operators import marts, rollups


def daily_sales_columns(daily: DataFrame) -> DataFrame:
    return daily.withColumnRenamed("total_returns", "returns").drop("return_rate_pct")


def category_metrics_columns(categories: DataFrame) -> DataFrame:
    return categories.select(
        "category", "total_orders", "total_revenue", "avg_order_value", "avg_rating", "avg_discount_pct", "return_rate_pct"
    )


def city_metrics_columns(cities: DataFrame) -> DataFrame:
    return cities.select("city", "total_orders", "total_revenue", "avg_order_value", "unique_customers")


def customer_segments_columns(customers: DataFrame) -> DataFrame:
    return marts.with_segment(customers).selectExpr(
        "customer_id",
        "frequency",
        "monetary",
        "recency_days",
        "first_order_date AS first_order",
        "last_order_date AS last_order",
        "customer_segment",
    )


def customer_spend_tiers_columns(customers: DataFrame) -> DataFrame:
    # Cents are exact: the rounded sum and the sum itself are the same number.
    return customers.selectExpr(
        "customer_id",
        "frequency AS total_orders",
        "monetary AS lifetime_value",
        "avg_order_value",
        "first_order_date AS first_order",
        "last_order_date AS last_order",
        f"{segment_by_spend('monetary')} AS customer_segment",
    )


def daily_sales(silver: DataFrame) -> DataFrame:
    return daily_sales_columns(rollups.by_day(silver))


def category_metrics(silver: DataFrame) -> DataFrame:
    return category_metrics_columns(rollups.by_category(silver))


def city_metrics(silver: DataFrame) -> DataFrame:
    return city_metrics_columns(rollups.by_city(silver))


def customer_segments(silver: DataFrame, as_of: date | None = None) -> DataFrame:
    return customer_segments_columns(rollups.by_customer(silver, as_of))


def customer_spend_tiers(silver: DataFrame) -> DataFrame:
    """Customers by lifetime spend alone."""
    return customer_spend_tiers_columns(rollups.by_customer(silver))
