"""Questions asked of the stored tables, and the feeds of the charts.

Reports are where order matters, so they sort; every sort ends on a unique key.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import week_label
from orderloom.functions.money import from_cents, mean_2dp, mean_money, percent_2dp, sum_money, to_cents


def top_categories(silver: DataFrame) -> DataFrame:
    """Orders, revenue and mean rating per category, in Spark SQL over silver."""
    return silver.sparkSession.sql(
        f"""
        SELECT category,
               count(*) AS orders,
               {sum_money('total_amount')} AS revenue,
               {mean_2dp('customer_rating')} AS avg_rating
        FROM {{sales}}
        GROUP BY category
        ORDER BY revenue DESC, category
        """,
        sales=silver,
    )


def category_performance(gold_categories: DataFrame) -> DataFrame:
    return gold_categories.select(
        "category", "total_revenue", "avg_order_value", "avg_rating", "return_rate_pct"
    ).orderBy(F.desc("total_revenue"), "category")


def category_chart(gold_categories: DataFrame) -> DataFrame:
    """Every category metric, by revenue: the bar-chart feed."""
    return gold_categories.orderBy(F.desc("total_revenue"), "category")


def city_rankings(gold_cities: DataFrame) -> DataFrame:
    return gold_cities.select(
        "city", "total_orders", "total_revenue", "avg_order_value", "unique_customers"
    ).orderBy(F.desc("total_revenue"), "city")


def segment_summary(spend_tiers: DataFrame) -> DataFrame:
    return (
        spend_tiers.groupBy("customer_segment")
        .agg(
            F.expr("count(*) AS customers"),
            F.expr(f"{mean_money('lifetime_value')} AS avg_ltv"),
            F.expr(f"{sum_money('lifetime_value')} AS segment_revenue"),
        )
        .orderBy(F.desc("avg_ltv"), "customer_segment")
    )


def quarterly_revenue(gold_daily: DataFrame) -> DataFrame:
    return (
        gold_daily.groupBy("order_year", "order_quarter")
        .agg(
            F.expr(f"{sum_money('total_revenue')} AS quarterly_revenue"),
            F.expr("sum(total_orders) AS total_orders"),
        )
        .orderBy("order_year", "order_quarter")
    )


def weekly_revenue(gold_daily: DataFrame) -> DataFrame:
    """Revenue per Monday-to-Sunday week."""
    return (
        gold_daily.groupBy(F.expr(f"{week_label('sale_date')} AS week"))
        .agg(F.expr(f"{sum_money('total_revenue')} AS total_revenue"))
        .orderBy("week")
    )


def segment_revenue_share(spend_tiers: DataFrame) -> DataFrame:
    """Customers, revenue and share of all revenue per segment: the donut feed.

    Whatever segments there are, a NULL one included. One more aggregate over these few
    rows holds them together with their total, so the customers are read once and there
    is no join or global window.
    """
    cents = to_cents("lifetime_value")
    # In decimals: ten thousand times a grand total can outgrow a BIGINT.
    share = percent_2dp("CAST(cents AS DECIMAL(22, 0))", "CAST(all_cents AS DECIMAL(22, 0))")
    return (
        spend_tiers.groupBy("customer_segment")
        .agg(F.expr("count(*) AS customers"), F.expr(f"sum({cents}) AS cents"))
        .agg(
            F.expr("sum(cents) AS all_cents"),
            F.expr("collect_list(struct(customer_segment, customers, cents)) AS segments"),
        )
        .selectExpr("all_cents", "inline(segments)")
        .selectExpr(
            "customer_segment",
            "customers",
            f"{from_cents('cents')} AS total_revenue",
            f"{share} AS revenue_share_pct",
        )
        .orderBy(F.desc("total_revenue"), "customer_segment")
    )


def layer_row_counts(tables: Iterable[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Row count per table, from (layer, table, frame, description)."""
    counted = [
        frame.groupBy()
        .agg(F.expr("count(*) AS row_count"))
        .select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(description).alias("description"),
        )
        for layer, name, frame, description in tables
    ]
    return reduce(DataFrame.unionByName, counted)
