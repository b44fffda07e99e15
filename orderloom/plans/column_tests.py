"""The declared column tests of silver, staging and marts (fixed values)."""

from __future__ import annotations

from orderloom.operators.quality import ColumnTest
from orderloom.schema import ACCEPTED_CATEGORIES, ACCEPTED_STATUSES, SEGMENTS

NOT_NULL = {
    "silver_orders": ["order_id", "customer_id", "total_amount"],
    "stg_orders": ["order_sk", "order_id", "customer_id", "total_amount"],
    "mart_daily_sales": ["sale_date", "total_revenue", "total_orders"],
    "mart_category_metrics": ["category", "total_revenue"],
    "mart_customer_segments": ["customer_id", "customer_segment", "monetary"],
    "mart_city_metrics": ["city", "total_revenue"],
}

UNIQUE = {
    "silver_orders": ["order_id"],
    "stg_orders": ["order_sk", "order_id"],
    "mart_daily_sales": ["sale_date"],
    "mart_category_metrics": ["category"],
    "mart_customer_segments": ["customer_id"],
    "mart_city_metrics": ["city"],
}


def not_null_tests() -> list[ColumnTest]:
    return [ColumnTest("not_null", model, c) for model, columns in NOT_NULL.items() for c in columns]


def unique_tests() -> list[ColumnTest]:
    return [ColumnTest("unique", model, c) for model, columns in UNIQUE.items() for c in columns]


def accepted_values_tests(categories: tuple[str, ...] = ACCEPTED_CATEGORIES) -> list[ColumnTest]:
    return [
        ColumnTest("accepted_values", "stg_orders", "status", ACCEPTED_STATUSES),
        ColumnTest("accepted_values", "mart_category_metrics", "category", categories),
        ColumnTest("accepted_values", "mart_customer_segments", "customer_segment", SEGMENTS),
    ]


def all_tests(categories: tuple[str, ...] = ACCEPTED_CATEGORIES) -> list[ColumnTest]:
    return not_null_tests() + unique_tests() + accepted_values_tests(categories)
