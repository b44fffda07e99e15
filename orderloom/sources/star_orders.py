"""Order lines derived from the star-schema test tables.

Every ``lineitem`` row is one order line. ``orders``, ``customer``, ``nation``
and ``part`` are attribute look-ups on their primary keys, so they are left
joins: a line is never lost because a look-up row is missing, and a look-up
nobody asked for is not joined at all. No join carries a hint: Catalyst
broadcasts a side only when its size is under the session's threshold and
shuffles otherwise, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from orderloom.functions.keys import padded_id
from orderloom.functions.money import from_cents
from orderloom.schema import BRONZE

# Raw columns that need a look-up; all others come from lineitem alone.
_FROM_ORDERS = {"payment_method", "status", "city"}
_FROM_CUSTOMER = {"city"}
_FROM_PART = {"category"}

_EXTENDED_CENTS = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
_PRICE_CENTS = f"({_EXTENDED_CENTS} % 49501 + 500)"
_QUANTITY = "((CAST(l_quantity AS BIGINT) - 1) % 5 + 1)"

_COLUMNS = {
    "order_id": f"concat_ws('-', 'ORD', l_orderkey, l_linenumber, l_partkey, l_suppkey, {_EXTENDED_CENTS})",
    "customer_id": padded_id("CUST-", "l_orderkey", 6),
    "product_id": padded_id("PROD-", "l_partkey", 5),
    "category": "p_type",
    "order_date": "l_shipdate",
    "quantity": _QUANTITY,
    "unit_price": from_cents(_PRICE_CENTS),
    "discount_pct": "rint(l_discount * 100)",
    "shipping_cost": from_cents("200 + 250 * l_linenumber"),
    "customer_rating": "nullif((l_partkey + l_suppkey) % 6, 0)",
    "payment_method": """CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Debit Card'
        WHEN '3-MEDIUM' THEN 'PayPal' ELSE 'Cash' END""",
    "city": "n_name",
    "status": """CASE WHEN l_returnflag = 'R' THEN 'returned'
        WHEN l_returnflag = 'A' AND o_orderstatus = 'F' THEN 'cancelled'
        WHEN l_linestatus = 'F' THEN 'delivered'
        WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'shipped' END""",
    "return_reason": """CASE WHEN l_returnflag = 'R' THEN
        CASE l_suppkey % 3 WHEN 0 THEN 'Defective' WHEN 1 THEN 'Wrong item' ELSE 'Changed mind' END END""",
}

# The dirty variant zeroes some quantities and negates some prices.
_DIRTY_COLUMNS = _COLUMNS | {
    "quantity": f"CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE {_QUANTITY} END",
    "unit_price": from_cents(f"CASE WHEN l_suppkey % 89 = 0 THEN -{_PRICE_CENTS} ELSE {_PRICE_CENTS} END"),
}


class StarOrders:
    """Order lines of one test folder; its tables are opened once and shared."""

    def __init__(self, spark: SparkSession, sf_dir: str, dirty: bool = False):
        self._spark = spark
        self._dir = sf_dir
        self._columns = _DIRTY_COLUMNS if dirty else _COLUMNS
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._tables[name]

    def orders(self, columns: Iterable[str] | None = None, without: Iterable[str] = ()) -> DataFrame:
        """Order lines in the bronze layout.

        ``columns`` or ``without`` narrow the result, and with it the look-ups.
        """
        skipped = set(without)
        names = [c for c in (columns or BRONZE.fieldNames()) if c not in skipped]
        wanted = set(names)
        lines = self._table("lineitem")
        if wanted & _FROM_ORDERS:
            headers = self._table("orders")
            if wanted & _FROM_CUSTOMER:
                # Customers with their nation's name first: the small sides meet
                # before the line-sized one is touched.
                places = _look_up(self._table("customer"), self._table("nation"), "c_nationkey", "n_nationkey")
                headers = _look_up(headers, places, "o_custkey", "c_custkey")
            lines = _look_up(lines, headers, "l_orderkey", "o_orderkey")
        if wanted & _FROM_PART:
            lines = _look_up(lines, self._table("part"), "l_partkey", "p_partkey")
        return lines.selectExpr(
            *[f"CAST({self._columns[c]} AS {BRONZE[c].dataType.simpleString()}) AS {c}" for c in names]
        )


def _look_up(rows: DataFrame, attributes: DataFrame, key: str, primary_key: str) -> DataFrame:
    """``rows`` with attributes. Each primary key is unique in its table, so no row is
    added, and counts need no look-up; the tests check the four keys."""
    return rows.join(attributes, rows[key] == attributes[primary_key], "left")


def raw_orders(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """All columns of all order lines."""
    return StarOrders(spark, sf_dir, dirty).orders()
