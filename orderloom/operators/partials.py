"""Roll-ups in two steps: exact partial sums per month, and their merge.

A month's partial has one row per (category, city, customer) with whole sums and
counts, least and greatest dates. Sums, means and dates of any roll-up follow from
these without a rounding in between, and so do exact distinct counts, as the counted
customers and categories are keys. Merging the partials of all months equals
aggregating the rows themselves; when one month changes, its rows alone are read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from orderloom.functions.money import divide_half_up, from_cents, percent_2dp, to_cents, to_hundredths
from orderloom.sources.monthly import MONTH_KEY

KEYS = ("category", "city", "customer_id")

_PARTIAL = {
    "orders": "count(*)",
    "items": "CAST(sum(quantity) AS BIGINT)",
    "cents": f"sum({to_cents('total_amount')})",
    "amounts": "count(total_amount)",
    "rating_hundredths": f"sum({to_hundredths('customer_rating')})",
    "ratings": "count(customer_rating)",
    "discount_hundredths": f"sum({to_hundredths('discount_pct')})",
    "discounts": "count(discount_pct)",
    "returns": "count_if(is_returned)",
    "first_order_date": "min(CAST(order_date AS DATE))",
    "last_order_date": "max(CAST(order_date AS DATE))",
}

SCHEMA = StructType(
    [StructField(key, StringType()) for key in KEYS]
    + [StructField(name, DateType() if name.endswith("_date") else LongType()) for name in _PARTIAL]
)


def _mean(total: str, count: str) -> str:
    return divide_half_up(f"sum({total})", f"sum({count})")


_MERGED = {
    "total_orders": "sum(orders)",
    "unique_customers": "count(DISTINCT customer_id)",
    "total_items_sold": "sum(items)",
    "total_revenue": from_cents("sum(cents)"),
    "avg_order_value": from_cents(_mean("cents", "amounts")),
    "avg_rating": f"CAST({_mean('rating_hundredths', 'ratings')} AS DOUBLE) / 100",
    "avg_discount_pct": f"CAST({_mean('discount_hundredths', 'discounts')} AS DOUBLE) / 100",
    "total_returns": "sum(returns)",
    "return_rate_pct": percent_2dp("sum(returns)", "sum(orders)"),
    "frequency": "sum(orders)",
    "monetary": from_cents("sum(cents)"),
    "first_order_date": "min(first_order_date)",
    "last_order_date": "max(last_order_date)",
    "categories_bought": "count(DISTINCT category)",
}


def _merged(*names: str) -> list[Column]:
    return [F.expr(f"{_MERGED[name]} AS {name}") for name in names]


def by_month(orders: DataFrame) -> DataFrame:
    """The partials of some months' rows, with the month's key.

    Combined on the map side, so a hot customer, city or category is one row per map
    task and month. The rebalance gives each month few files.
    """
    month = F.expr(f"year(order_date) * 100 + month(order_date) AS {MONTH_KEY}")
    sums = [F.expr(f"{sql} AS {name}") for name, sql in _PARTIAL.items()]
    return orders.groupBy(month, *KEYS).agg(*sums).hint("rebalance", MONTH_KEY)


def by_category(partials: DataFrame) -> DataFrame:
    """``rollups.by_category`` of the rows behind the partials."""
    return partials.groupBy("category").agg(
        *_merged(
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


def by_city(partials: DataFrame) -> DataFrame:
    """``rollups.by_city`` of the rows behind the partials."""
    return partials.groupBy("city").agg(
        *_merged(
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


def by_customer(partials: DataFrame, as_of: date | None = None) -> DataFrame:
    """``marts.customer_rollup`` of the rows behind the partials."""
    today = f"DATE '{as_of}'" if as_of else "current_date()"
    return partials.groupBy("customer_id").agg(
        *_merged("frequency", "monetary", "avg_order_value"),
        F.expr(f"datediff({today}, {_MERGED['last_order_date']}) AS recency_days"),
        *_merged("first_order_date", "last_order_date", "avg_rating", "categories_bought"),
    )
