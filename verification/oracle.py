"""One SQL text per registered query, on the star-schema test tables.

All texts build on the same CTE chain ``raw -> silver`` in integer cents and
select DOUBLE money, so a match means equality and not closeness.
"""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"
LOADED_UNTIL = "DATE '2001-01-01'"
ACCEPTED_PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero, NULL for a zero denominator."""
    return (
        f"(CASE WHEN ({numerator}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs({numerator}) + ({denominator})) // (2 * nullif({denominator}, 0))))"
    )


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def mean_money(cents: str) -> str:
    return money(half_up(f"sum({cents})", f"count({cents})"))


def percent(part: str, whole: str) -> str:
    return money(half_up(f"({part}) * 10000", whole))


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def ctes(dirty: bool = False, clean: bool = True) -> str:
    """``raw`` and ``silver``; without ``clean`` silver keeps the invalid rows."""
    price = "CAST(round(l_extendedprice * 100) AS BIGINT) % 49501 + 500"
    quantity = "(CAST(l_quantity AS BIGINT) - 1) % 5 + 1"
    if dirty:
        price = f"CASE WHEN l_suppkey % 89 = 0 THEN -({price}) ELSE {price} END"
        quantity = f"CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE {quantity} END"
    keep = "unit_cents > 0 AND quantity > 0 AND status IS DISTINCT FROM 'cancelled'" if clean else "true"
    return f"""
WITH raw AS (
    SELECT
        'ORD-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
            || CAST(round(l_extendedprice * 100) AS BIGINT) AS order_id,
        printf('CUST-%06d', l_orderkey) AS customer_id,
        printf('PROD-%05d', l_partkey) AS product_id,
        p_type AS category,
        CAST(l_shipdate AS DATE) AS order_date,
        CAST({quantity} AS INTEGER) AS quantity,
        {price} AS unit_cents,
        CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
        CAST(200 + 250 * l_linenumber AS BIGINT) AS shipping_cents,
        CAST(nullif((l_partkey + l_suppkey) % 6, 0) AS DOUBLE) AS customer_rating,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Debit Card'
            WHEN '3-MEDIUM' THEN 'PayPal' ELSE 'Cash' END AS payment_method,
        n_name AS city,
        CASE WHEN l_returnflag = 'R' THEN 'returned'
            WHEN l_returnflag = 'A' AND o_orderstatus = 'F' THEN 'cancelled'
            WHEN l_linestatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'P' THEN 'pending'
            ELSE 'shipped' END AS status,
        CASE WHEN l_returnflag = 'R' THEN CASE l_suppkey % 3 WHEN 0 THEN 'Defective'
            WHEN 1 THEN 'Wrong item' ELSE 'Changed mind' END END AS return_reason
    FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN part ON p_partkey = l_partkey
),
kept AS (
    SELECT * EXCLUDE (customer_rating, return_reason),
        coalesce(customer_rating, 0.0) AS customer_rating,
        coalesce(return_reason, 'No Return') AS return_reason,
        unit_cents * quantity AS gross,
        {half_up('unit_cents * quantity * discount_pct', '100')} AS discount
    FROM raw WHERE {keep}
),
silver AS (
    SELECT *, gross - discount AS net, gross - discount + shipping_cents AS total,
        CAST(year(order_date) AS INTEGER) AS order_year,
        CAST(month(order_date) AS INTEGER) AS order_month,
        CAST(quarter(order_date) AS INTEGER) AS order_quarter,
        dayname(order_date) AS order_day_name,
        coalesce(dayname(order_date) IN ('Saturday', 'Sunday'), false) AS is_weekend,
        coalesce(status = 'returned', false) AS is_returned,
        CAST(round(customer_rating * 100) AS BIGINT) AS rating_hundredths
    FROM kept
)
"""


RAW_ROW = f"""
    order_id, customer_id, product_id, category, order_date, quantity, {money('unit_cents')} AS unit_price,
    discount_pct, {money('shipping_cents')} AS shipping_cost, customer_rating, payment_method, city, status,
    return_reason"""

AMOUNTS = f"""
    {money('gross')} AS gross_amount, {money('discount')} AS discount_amount,
    {money('net')} AS net_amount, {money('total')} AS total_amount"""

CALENDAR = "order_year, order_month, order_quarter, order_day_name, is_weekend"

SILVER_ROW = f"{RAW_ROW}, {AMOUNTS}, {CALENDAR}, is_returned"

ORDERS = "count(*) AS total_orders"
CUSTOMERS = "count(DISTINCT customer_id) AS unique_customers"
ITEMS = f"{big('sum(quantity)')} AS total_items_sold"
REVENUE = f"{money('sum(total)')} AS total_revenue"
ORDER_VALUE = f"{mean_money('total')} AS avg_order_value"
RATING = f"{mean_money('rating_hundredths')} AS avg_rating"
DISCOUNT_PCT = f"{money(half_up('sum(discount_pct * 100)', 'count(discount_pct)'))} AS avg_discount_pct"
RETURNED = "count(*) FILTER (WHERE is_returned)"
RETURN_RATE = f"{percent(RETURNED, 'count(*)')} AS return_rate_pct"
DAILY_MONEY = f"""
    {money('sum(gross)')} AS gross_revenue, {money('sum(discount)')} AS total_discounts,
    {money('sum(net)')} AS net_revenue, {REVENUE}, {ORDER_VALUE}"""
RECENCY = f"CAST(date_diff('day', max(order_date), {AS_OF}) AS INTEGER) AS recency_days"

SPEND_AND_FREQUENCY = """CASE WHEN sum(total) > 200000 AND count(*) >= 5 THEN 'VIP'
    WHEN sum(total) > 100000 AND count(*) >= 3 THEN 'Premium'
    WHEN sum(total) > 50000 THEN 'Regular' ELSE 'New' END AS customer_segment"""
SPEND_ONLY = """CASE WHEN sum(total) > 200000 THEN 'VIP' WHEN sum(total) > 100000 THEN 'Premium'
    WHEN sum(total) > 50000 THEN 'Regular' ELSE 'New' END AS customer_segment"""

TIERS = f"""tiers AS (
    SELECT customer_id, count(*) AS n, {big('sum(total)')} AS cents, {SPEND_ONLY}
    FROM silver GROUP BY customer_id)"""


def _select(columns: str, table: str = "silver", tail: str = "", dirty: bool = False, clean: bool = True) -> str:
    return f"{ctes(dirty, clean)} SELECT {columns} FROM {table} {tail}"


def _expectations(dirty: bool, clean: bool) -> str:
    rules = {
        "no_negative_price": "unit_cents < 0",
        "no_zero_quantity": "quantity = 0",
        "no_missing_customer": "customer_id IS NULL",
        "no_cancelled_order": "status = 'cancelled'",
        "no_negative_total": "total < 0",
        "price_above_zero": "unit_cents <= 0",
        "total_above_zero": "total <= 0",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {rule}) AS got FROM silver"
        for name, rule in rules.items()
    )
    return f"{ctes(dirty, clean)} SELECT check_name, got, CAST(0 AS BIGINT) AS expected, got = 0 AS passed FROM ({rows})"


_CUSTOMER_TABLE = f"SELECT customer_id, {SPEND_AND_FREQUENCY} FROM silver GROUP BY customer_id"


def _reconciliation() -> str:
    rows = f"""
    SELECT 'categories_match_silver' AS check_name,
        (SELECT count(*) FROM (SELECT category FROM silver GROUP BY category)) AS got,
        (SELECT count(DISTINCT category) FROM silver) AS expected
    UNION ALL SELECT 'cities_match_silver',
        (SELECT count(*) FROM (SELECT city FROM silver GROUP BY city)),
        (SELECT count(DISTINCT city) FROM silver)
    UNION ALL SELECT 'all_segments_present',
        (SELECT count(DISTINCT customer_segment) FROM ({_CUSTOMER_TABLE})), CAST(4 AS BIGINT)"""
    return f"{ctes(True)} SELECT check_name, got, expected, got = expected AS passed FROM ({rows})"


_MODEL_SQL = {
    "silver_orders": "SELECT *, total AS total_amount FROM silver",
    "stg_orders": "SELECT *, md5(order_id) AS order_sk, total AS total_amount FROM silver",
    "mart_daily_sales": "SELECT order_date AS sale_date, sum(total) AS total_revenue, count(*) AS total_orders "
    "FROM silver GROUP BY order_date",
    "mart_category_metrics": "SELECT category, sum(total) AS total_revenue FROM silver GROUP BY category",
    "mart_customer_segments": f"SELECT customer_id, sum(total) AS monetary, {SPEND_AND_FREQUENCY} "
    "FROM silver GROUP BY customer_id",
    "mart_city_metrics": "SELECT city, sum(total) AS total_revenue FROM silver GROUP BY city",
}


def _column_tests(rows: list[str]) -> str:
    return f"""{ctes(True)}
    SELECT test, model, column_name, failures, failures = 0 AS passed FROM ({' UNION ALL '.join(rows)})"""


def _not_null(declared: dict[str, list[str]]) -> str:
    return _column_tests(
        [
            f"SELECT 'not_null' AS test, '{model}' AS model, '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM ({_MODEL_SQL[model]})"
            for model, columns in declared.items()
            for c in columns
        ]
    )


def _unique(declared: dict[str, list[str]]) -> str:
    return _column_tests(
        [
            f"SELECT 'unique' AS test, '{model}' AS model, '{c}' AS column_name, count(*) AS failures "
            f"FROM (SELECT {c} FROM ({_MODEL_SQL[model]}) WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            for model, columns in declared.items()
            for c in columns
        ]
    )


def _accepted(declared: list[tuple[str, str, tuple[str, ...]]]) -> str:
    return _column_tests(
        [
            f"SELECT 'accepted_values' AS test, '{model}' AS model, '{c}' AS column_name, "
            f"count(DISTINCT {c}) AS failures FROM ({_MODEL_SQL[model]}) "
            f"WHERE {c} NOT IN ({', '.join(repr(v) for v in values)})"
            for model, c, values in declared
        ]
    )


def build() -> dict[str, str]:
    from orderloom.plans.column_tests import NOT_NULL, UNIQUE
    from orderloom.schema import ACCEPTED_STATUSES, SEGMENTS

    loaded = f"loaded AS (SELECT * FROM raw WHERE order_date <= {LOADED_UNTIL})"
    fresh = "fresh AS (SELECT * FROM raw WHERE order_date > (SELECT max(order_date) FROM loaded))"
    category_columns = f"category, {ORDERS}, {REVENUE}, {ORDER_VALUE}, {RATING}, {DISCOUNT_PCT}, {RETURN_RATE}"
    city_columns = f"city, {ORDERS}, {REVENUE}, {ORDER_VALUE}, {CUSTOMERS}"
    day_key = "order_date AS sale_date, order_year, order_month, order_quarter"
    by_day = "GROUP BY order_date, order_year, order_month, order_quarter"
    monday = "CAST(date_trunc('week', order_date) AS DATE)"

    def counted(layer: str, name: str, rows: str, description: str) -> str:
        return (
            f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count, "
            f"'{description}' AS description FROM {rows}"
        )

    return {
        # source and silver
        "raw_orders": _select(RAW_ROW, "raw"),
        "silver_filter": _select(RAW_ROW, "raw", "WHERE unit_cents > 0 AND quantity > 0 AND status IS DISTINCT FROM 'cancelled'", dirty=True),
        "silver_fillna": _select("order_id, customer_rating, return_reason", dirty=True, clean=False),
        "silver_amounts": _select(f"order_id, {AMOUNTS}", dirty=True, clean=False),
        "silver_calendar": _select(f"order_id, order_date, {CALENDAR}", clean=False),
        "silver_flags": _select("order_id, status, is_returned", clean=False),
        "silver_orders": _select(SILVER_ROW, dirty=True),
        "silver_drop_summary": f"""{ctes(True)} SELECT original_rows, kept_rows, original_rows - kept_rows AS dropped_rows,
            CAST({half_up('(original_rows - kept_rows) * 1000', 'original_rows')} AS DOUBLE) / 10 AS dropped_pct
            FROM (SELECT (SELECT count(*) FROM raw) AS original_rows, (SELECT count(*) FROM silver) AS kept_rows)""",
        "stg_orders": _select(f"md5(order_id) AS order_sk, {SILVER_ROW}"),
        # incremental load
        "incremental_watermark": f"{ctes()}, {loaded} SELECT max(order_date) AS watermark FROM loaded",
        "incremental_new_rows": f"{ctes()}, {loaded}, {fresh} SELECT {RAW_ROW} FROM fresh",
        "incremental_append": f"{ctes()}, {loaded}, {fresh} SELECT {RAW_ROW} FROM (SELECT * FROM loaded UNION ALL SELECT * FROM fresh)",
        # gold
        "gold_daily_sales": _select(f"{day_key}, {ORDERS}, {CUSTOMERS}, {ITEMS}, {DAILY_MONEY}, {RETURNED} AS returns", tail=by_day),
        "gold_category_metrics": _select(category_columns, tail="GROUP BY category"),
        "gold_customer_segments": _select(
            f"customer_id, count(*) AS frequency, {money('sum(total)')} AS monetary, {RECENCY}, "
            f"min(order_date) AS first_order, max(order_date) AS last_order, {SPEND_AND_FREQUENCY}",
            tail="GROUP BY customer_id",
        ),
        "gold_customer_spend_tiers": _select(
            f"customer_id, {ORDERS}, {money('sum(total)')} AS lifetime_value, {ORDER_VALUE}, "
            f"min(order_date) AS first_order, max(order_date) AS last_order, {SPEND_ONLY}",
            tail="GROUP BY customer_id",
        ),
        "gold_city_metrics": _select(city_columns, tail="GROUP BY city"),
        "distinct_segments": f"{ctes()} SELECT DISTINCT customer_segment FROM ({_CUSTOMER_TABLE})",
        # marts
        "mart_daily_sales": _select(
            f"{day_key}, {ORDERS}, {CUSTOMERS}, {ITEMS}, {DAILY_MONEY}, {RETURNED} AS total_returns, {RETURN_RATE}", tail=by_day
        ),
        "mart_category_metrics": _select(
            f"{category_columns}, {CUSTOMERS}, {ITEMS}, {RETURNED} AS total_returns", tail="GROUP BY category"
        ),
        "mart_customer_segments": _select(
            f"customer_id, count(*) AS frequency, {money('sum(total)')} AS monetary, {RECENCY}, "
            f"min(order_date) AS first_order_date, max(order_date) AS last_order_date, {RATING}, "
            f"count(DISTINCT category) AS categories_bought, {SPEND_AND_FREQUENCY}",
            tail="GROUP BY customer_id",
        ),
        "mart_city_metrics": _select(
            f"{city_columns}, {ITEMS}, {RATING}, {RETURNED} AS total_returns, {RETURN_RATE}", tail="GROUP BY city"
        ),
        # reports
        "report_top_categories": _select(
            f"category, count(*) AS orders, {money('sum(total)')} AS revenue, {RATING}", tail="GROUP BY category"
        ),
        "report_category_performance": _select(
            f"category, {REVENUE}, {ORDER_VALUE}, {RATING}, {RETURN_RATE}", tail="GROUP BY category"
        ),
        "report_category_chart": _select(category_columns, tail="GROUP BY category"),
        "report_segment_summary": f"""{ctes()}, {TIERS} SELECT customer_segment, count(*) AS customers,
            {mean_money('cents')} AS avg_ltv, {money('sum(cents)')} AS segment_revenue FROM tiers GROUP BY customer_segment""",
        "report_city_rankings": _select(city_columns, tail="GROUP BY city"),
        "report_quarterly_revenue": _select(
            f"order_year, order_quarter, {money('sum(total)')} AS quarterly_revenue, {ORDERS}",
            tail="GROUP BY order_year, order_quarter",
        ),
        "report_weekly_revenue": _select(
            f"{monday} || '/' || CAST({monday} + 6 AS DATE) AS week, {REVENUE}", tail=f"GROUP BY {monday}"
        ),
        "report_segment_revenue_share": f"""{ctes()}, {TIERS} SELECT customer_segment, count(*) AS customers,
            {money('sum(cents)')} AS total_revenue,
            {money(half_up('sum(cents) * 10000', '(SELECT sum(cents) FROM tiers)'))} AS revenue_share_pct
            FROM tiers GROUP BY customer_segment""",
        "layer_row_counts": ctes()
        + " UNION ALL ".join(
            [
                counted("BRONZE", "bronze_orders", "raw", "order lines as loaded"),
                counted("SILVER", "silver_orders", "silver", "valid order lines with derived columns"),
                counted("GOLD", "gold_daily_sales", "(SELECT DISTINCT order_date FROM silver)", "sales per day"),
                counted("GOLD", "gold_category_metrics", "(SELECT DISTINCT category FROM silver)", "sales per category"),
                counted("GOLD", "gold_customer_segments", "(SELECT DISTINCT customer_id FROM silver)", "spend and segment per customer"),
                counted("GOLD", "gold_city_metrics", "(SELECT DISTINCT city FROM silver)", "sales per city"),
            ]
        ),
        # quality
        "dq_expectations": _expectations(dirty=True, clean=False),
        "dq_expectations_silver": _expectations(dirty=True, clean=True),
        "dq_reconciliation": _reconciliation(),
        "dq_fixed_counts": f"""{ctes(True)} SELECT check_name, got, expected, got = expected AS passed FROM (
            SELECT 'category_count' AS check_name, count(*) AS got, CAST(9 AS BIGINT) AS expected
            FROM (SELECT category FROM silver GROUP BY category)
            UNION ALL SELECT 'segment_count', count(DISTINCT customer_segment), CAST(4 AS BIGINT) FROM ({_CUSTOMER_TABLE}))""",
        "dq_total_revenue": f"{ctes(True)} SELECT {REVENUE} FROM silver",
        "dq_not_null": _not_null(NOT_NULL),
        "dq_unique": _unique(UNIQUE),
        "dq_accepted_values": _accepted(
            [
                ("stg_orders", "status", ACCEPTED_STATUSES),
                ("mart_category_metrics", "category", ACCEPTED_PART_TYPES),
                ("mart_customer_segments", "customer_segment", SEGMENTS),
            ]
        ),
        "dq_duplicate_keys": _select(
            "customer_id, count(*) AS occurrences", tail="GROUP BY customer_id HAVING count(*) > 1", dirty=True
        ),
        "dq_unaccepted_values": _select(
            "category, count(*) AS occurrences",
            tail=f"WHERE category NOT IN ({', '.join(repr(v) for v in ACCEPTED_PART_TYPES)}) GROUP BY category",
            dirty=True,
        ),
    }
