"""Gold, marts and reports on small tables against plain Python."""

from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from orderloom.operators import gold, marts, reports
from orderloom.operators.cleaning import clean_orders
from orderloom.operators.staging import stg_orders

AS_OF = date(2024, 3, 1)
CENT = Decimal("0.01")


@pytest.fixture(scope="module")
def silver(bronze_rows, spark):
    """240 orders; one customer, one city and one day hold a third of them."""
    rows = []
    for i in range(240):
        hot = i % 3 == 0
        rows.append(
            {
                "order_id": f"ORD-{i}",
                "customer_id": "CUST-000001" if hot else f"CUST-{i % 17:06d}",
                "category": ["Books", "Toys", "Beauty", None][i % 4],
                "city": "Dallas" if hot else ["Austin", "Chicago"][i % 2],
                "order_date": None if i == 7 else date(2024, 1, 1) + timedelta(days=0 if hot else i % 40),
                "quantity": 1 + i % 5,
                "unit_price": Decimal(500 + 37 * i) * CENT,
                "discount_pct": None if i == 10 else i % 20,
                "shipping_cost": Decimal(i * 3) * CENT,
                "customer_rating": None if i % 6 == 0 else float(1 + i % 5),
                "status": ["delivered", "returned", "shipped", "pending"][i // 2 % 4],
            }
        )
    frame = clean_orders(bronze_rows(*rows))
    frame.persist()
    yield frame
    frame.unpersist()


def _round(numerator: Decimal, denominator: int) -> Decimal:
    return (Decimal(numerator) / denominator).quantize(CENT, ROUND_HALF_UP)


def _groups(silver, key):
    groups = defaultdict(list)
    for row in silver.collect():
        groups[row[key]].append(row)
    return groups


def _measures(rows):
    totals = [r["total_amount"] for r in rows if r["total_amount"] is not None]
    discounts = [r["discount_pct"] for r in rows if r["discount_pct"] is not None]
    returned = sum(r["is_returned"] for r in rows)
    dates = [r["order_date"] for r in rows if r["order_date"] is not None]
    return {
        "total_orders": len(rows),
        "frequency": len(rows),
        "unique_customers": len({r["customer_id"] for r in rows}),
        "categories_bought": len({r["category"] for r in rows} - {None}),
        "total_items_sold": sum(r["quantity"] for r in rows),
        "gross_revenue": sum(r["gross_amount"] for r in rows),
        "total_discounts": sum(r["discount_amount"] or 0 for r in rows),
        "net_revenue": sum(r["net_amount"] or 0 for r in rows),
        "total_revenue": sum(totals),
        "monetary": sum(totals),
        "lifetime_value": sum(totals),
        "avg_order_value": _round(sum(totals), len(totals)),
        "avg_rating": float(_round(sum(r["customer_rating"] for r in rows), len(rows))),
        "avg_discount_pct": float(_round(sum(discounts), len(discounts))),
        "total_returns": returned,
        "returns": returned,
        "return_rate_pct": float(_round(Decimal(100 * returned), len(rows))),
        "first_order": min(dates),
        "last_order": max(dates),
        "first_order_date": min(dates),
        "last_order_date": max(dates),
        "recency_days": (AS_OF - max(dates)).days,
    }


def _check(frame, key, silver, group_by):
    groups = _groups(silver, group_by)
    rows = frame.collect()
    assert {r[key] for r in rows} == set(groups) and len(rows) == len(groups)
    for row in rows:
        if row[key] is None and group_by == "order_date":
            continue
        expected = _measures(groups[row[key]])
        for column, value in row.asDict().items():
            if column in expected:
                assert value == expected[column], (row[key], column)
    return rows


@pytest.mark.parametrize("build", [gold.daily_sales, lambda s: marts.daily_sales(stg_orders(s))])
def test_daily(silver, build):
    rows = _check(build(silver), "sale_date", silver, "order_date")
    for row in rows:
        day = row["sale_date"]
        parts = (row["order_year"], row["order_month"], row["order_quarter"])
        assert parts == ((day.year, day.month, (day.month + 2) // 3) if day else (None, None, None))


@pytest.mark.parametrize("build", [gold.category_metrics, lambda s: marts.category_metrics(stg_orders(s))])
def test_category(silver, build):
    _check(build(silver), "category", silver, "category")


@pytest.mark.parametrize("build", [gold.city_metrics, lambda s: marts.city_metrics(stg_orders(s))])
def test_city(silver, build):
    _check(build(silver), "city", silver, "city")


@pytest.mark.parametrize(
    "build",
    [
        lambda s: gold.customer_segments(s, AS_OF),
        gold.customer_spend_tiers,
        lambda s: marts.customer_segments(stg_orders(s), AS_OF),
    ],
)
def test_customers(silver, build):
    _check(build(silver), "customer_id", silver, "customer_id")


def test_recency_defaults_to_today(silver):
    row = gold.customer_segments(silver).selectExpr("max(recency_days - datediff(current_date(), last_order)) AS off").first()
    assert row["off"] == 0


def test_column_lists(silver):
    assert gold.daily_sales(silver).columns == [
        "sale_date", "order_year", "order_month", "order_quarter", "total_orders", "unique_customers",
        "total_items_sold", "gross_revenue", "total_discounts", "net_revenue", "total_revenue",
        "avg_order_value", "returns",
    ]
    assert marts.daily_sales(silver).columns == [
        *gold.daily_sales(silver).columns[:-1], "total_returns", "return_rate_pct"
    ]
    assert gold.customer_segments(silver).columns == [
        "customer_id", "frequency", "monetary", "recency_days", "first_order", "last_order", "customer_segment"
    ]
    assert marts.customer_segments(silver).columns == [
        "customer_id", "frequency", "monetary", "recency_days", "first_order_date", "last_order_date",
        "avg_rating", "categories_bought", "customer_segment",
    ]


def test_empty_silver_gives_empty_tables(silver):
    none = silver.where("false")
    assert gold.daily_sales(none).count() == 0
    assert marts.customer_segments(stg_orders(none), AS_OF).count() == 0
    assert reports.segment_revenue_share(gold.customer_spend_tiers(none)).count() == 0


# -- reports ------------------------------------------------------------------


def test_top_categories_leaves_no_view_behind(spark, silver):
    before = {t.name for t in spark.catalog.listTables()}
    rows = reports.top_categories(silver).collect()
    assert [r["revenue"] for r in rows] == sorted((r["revenue"] for r in rows), reverse=True)
    assert sum(r["orders"] for r in rows) == 240
    assert {t.name for t in spark.catalog.listTables()} == before


def test_ordered_reports(silver):
    categories, cities = gold.category_metrics(silver), gold.city_metrics(silver)
    for frame in (reports.category_performance(categories), reports.category_chart(categories), reports.city_rankings(cities)):
        revenue = [r["total_revenue"] for r in frame.collect()]
        assert revenue == sorted(revenue, reverse=True)
    assert reports.category_performance(categories).columns == [
        "category", "total_revenue", "avg_order_value", "avg_rating", "return_rate_pct"
    ]


def test_quarterly_and_weekly_totals(silver):
    daily = gold.daily_sales(silver)
    whole = sum(r["total_amount"] or 0 for r in silver.collect())
    quarters = reports.quarterly_revenue(daily).collect()
    assert sum(r["quarterly_revenue"] for r in quarters) == whole
    assert sum(r["total_orders"] for r in quarters) == 240
    weeks = reports.weekly_revenue(daily).collect()
    assert sum(r["total_revenue"] for r in weeks) == whole
    assert [r["week"] for r in weeks][:2] == [None, "2024-01-01/2024-01-07"]


def test_segment_reports(spark):
    tiers = spark.sql(
        """SELECT * FROM VALUES ('a', 3000.00BD, 'VIP'), ('b', 2000.01BD, 'VIP'), ('c', 600.00BD, 'Regular'),
           ('d', 0.01BD, 'New') AS t(customer_id, lifetime_value, customer_segment)"""
    )
    assert [tuple(r) for r in reports.segment_summary(tiers).collect()] == [
        ("VIP", 2, Decimal("2500.01"), Decimal("5000.01")),
        ("Regular", 1, Decimal("600.00"), Decimal("600.00")),
        ("New", 1, Decimal("0.01"), Decimal("0.01")),
    ]
    assert [tuple(r) for r in reports.segment_revenue_share(tiers).collect()] == [
        ("VIP", 2, Decimal("5000.01"), 89.29),
        ("Regular", 1, Decimal("600.00"), 10.71),
        ("New", 1, Decimal("0.01"), 0.0),
    ]


def test_totals_far_beyond_double_precision(spark):
    """Grand totals of a very large table stay exact to the cent."""
    rows = spark.sql("SELECT 'x' AS customer_id, 'VIP' AS customer_segment, 4000000000000000.01BD AS lifetime_value")
    tiers = rows.unionByName(rows)
    assert reports.segment_summary(tiers).first()["segment_revenue"] == Decimal("8000000000000000.02")


def test_layer_row_counts(silver):
    got = reports.layer_row_counts([("A", "t", silver, "all"), ("B", "u", silver.where("false"), "none")])
    assert [tuple(r) for r in got.orderBy("layer").collect()] == [("A", "t", 240, "all"), ("B", "u", 0, "none")]


def test_revenue_share_covers_every_segment(spark):
    rows = [("Gold", "100.00"), ("VIP", "50.00"), (None, "50.00"), ("VIP", "0.00")]
    tiers = spark.createDataFrame(rows, "customer_segment string, amount string").selectExpr(
        "customer_segment", "CAST(amount AS DECIMAL(18, 2)) AS lifetime_value"
    )
    got = {r["customer_segment"]: (r["customers"], r["revenue_share_pct"]) for r in reports.segment_revenue_share(tiers).collect()}
    assert got == {"Gold": (1, 50.0), "VIP": (2, 25.0), None: (1, 25.0)}
    assert reports.segment_revenue_share(tiers.where("false")).count() == 0


def test_quarters_and_weeks_come_in_order(spark):
    days = spark.range(0, 900, 7).selectExpr(
        "date_add(DATE '2020-11-02', CAST(id AS INT)) AS sale_date", "CAST(1 AS DECIMAL(18, 2)) AS total_revenue", "1L AS total_orders"
    ).selectExpr("*", "year(sale_date) AS order_year", "quarter(sale_date) AS order_quarter").orderBy("total_orders", "order_quarter")
    weeks = [r["week"] for r in reports.weekly_revenue(days).collect()]
    quarters = [(r["order_year"], r["order_quarter"]) for r in reports.quarterly_revenue(days).collect()]
    assert weeks == sorted(weeks) and len(weeks) == 129
    assert quarters == sorted(quarters) and len(quarters) == 11


def test_layer_counts_take_any_text(spark):
    row = reports.layer_row_counts([("GOLD's", "t", spark.range(3), "it's \\ 'quoted'")]).first()
    assert tuple(row) == ("GOLD's", "t", 3, "it's \\ 'quoted'")
