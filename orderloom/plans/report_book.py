"""All reports over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.operators import reports
from orderloom.sources.lake import SILVER_TABLE, Lake


def report_book(lake: Lake) -> dict[str, DataFrame]:
    """Report name to its (lazy) result."""
    categories = lake.table("gold_category_metrics")
    tiers = lake.table("gold_customer_spend_tiers")
    daily = lake.table("gold_daily_sales")
    return {
        "top categories": reports.top_categories(lake.table(SILVER_TABLE)),
        "category performance": reports.category_performance(categories),
        "category chart": reports.category_chart(categories),
        "segment summary": reports.segment_summary(tiers),
        "segment revenue share": reports.segment_revenue_share(tiers),
        "city rankings": reports.city_rankings(lake.table("gold_city_metrics")),
        "revenue by quarter": reports.quarterly_revenue(daily),
        "revenue by week": reports.weekly_revenue(daily),
    }
