"""The four aggregates behind the gold and mart tables.

Each returns every measure of its grain. A caller that selects fewer columns
pays for those only: Catalyst drops unused aggregate functions, and with the
last exact distinct count goes the shuffle it needs.

All aggregates combine on the map side before they shuffle, so a key that holds
a large share of the rows arrives at its reducer as one row per map task. An
exact distinct count is planned on (key, counted column) first, which spreads a
hot key over all reducers.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import period_parts
from orderloom.functions.money import mean_2dp, mean_money, percent_2dp, sum_money

_MEASURES = {
    "total_orders": "count(*)",
    "unique_customers": "count(DISTINCT customer_id)",
    "total_items_sold": "CAST(sum(quantity) AS BIGINT)",
    "gross_revenue": sum_money("gross_amount"),
    "total_discounts": sum_money("discount_amount"),
    "net_revenue": sum_money("net_amount"),
    "total_revenue": sum_money("total_amount"),
    "avg_order_value": mean_money("total_amount"),
    "avg_rating": mean_2dp("customer_rating"),
    "avg_discount_pct": mean_2dp("discount_pct"),
    "total_returns": "count_if(is_returned)",
    "return_rate_pct": percent_2dp("count_if(is_returned)", "count(*)"),
    "frequency": "count(*)",
    "monetary": sum_money("total_amount"),
    "first_order_date": "min(CAST(order_date AS DATE))",
    "last_order_date": "max(CAST(order_date AS DATE))",
    "categories_bought": "count(DISTINCT category)",
}


def _measures(*names: str) -> list[Column]:
    return [F.expr(f"{_MEASURES[name]} AS {name}") for name in names]


def by_day(orders: DataFrame) -> DataFrame:
    """One row per day. Year, month and quarter follow from the day, so they are
    derived afterwards instead of widening the grouping key."""
    measures = (
        "total_orders",
        "unique_customers",
        "total_items_sold",
        "gross_revenue",
        "total_discounts",
        "net_revenue",
        "total_revenue",
        "avg_order_value",
        "total_returns",
        "return_rate_pct",
    )
    daily = orders.groupBy(F.expr("CAST(order_date AS DATE) AS sale_date")).agg(*_measures(*measures))
    periods = [f"{sql} AS {name}" for name, sql in period_parts("sale_date").items()]
    return daily.selectExpr("sale_date", *periods, *measures)


def by_category(orders: DataFrame) -> DataFrame:
    """One row per category."""
    return orders.groupBy("category").agg(
        *_measures(
            "total_orders",
            "unique_customers",
            "total_items_sold",
            "total_revenue",
            "avg_order_value",
            "avg_rating",
            "avg_discount_pct",
            "total_returns",
            "return_rate_pct",
        )
    )


def by_city(orders: DataFrame) -> DataFrame:
    """One row per city."""
    return orders.groupBy("city").agg(
        *_measures(
            "total_orders",
            "unique_customers",
            "total_items_sold",
            "total_revenue",
            "avg_order_value",
            "avg_rating",
            "total_returns",
            "return_rate_pct",
        )
    )


def by_customer(orders: DataFrame, as_of: date | None = None, *more: str) -> DataFrame:
    """One row per customer, with any further measures a caller names.

    ``as_of`` is the day recency counts to: today unless given.
    """
    today = f"DATE '{as_of}'" if as_of else "current_date()"
    return orders.groupBy("customer_id").agg(
        *_measures("frequency", "monetary", "avg_order_value"),
        F.expr(f"datediff({today}, {_MEASURES['last_order_date']}) AS recency_days"),
        *_measures("first_order_date", "last_order_date", *more),
    )
