from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderloom.schema import BRONZE  # noqa: E402
from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "orderloom-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


VALID_ORDER = {
    "order_id": "ORD-1",
    "customer_id": "CUST-000001",
    "product_id": "PROD-00001",
    "category": "Books",
    "order_date": date(2024, 1, 1),
    "quantity": 1,
    "unit_price": Decimal("10.00"),
    "discount_pct": 0,
    "shipping_cost": Decimal("0.00"),
    "customer_rating": 4.0,
    "payment_method": "PayPal",
    "city": "Austin",
    "status": "delivered",
    "return_reason": None,
}


@pytest.fixture(scope="session")
def bronze_rows(spark):
    """Bronze frame from partial rows; missing columns take valid values."""

    def build(*rows: dict):
        filled = [
            {**VALID_ORDER, "order_id": f"ORD-{i}", **row} for i, row in enumerate(rows, start=1)
        ]
        return spark.createDataFrame([tuple(r[c] for c in BRONZE.fieldNames()) for r in filled], BRONZE)

    return build


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate SQL expressions over literal rows."""

    def evaluate(rows: str, *expressions: str) -> list[tuple]:
        return [tuple(r) for r in spark.sql(f"SELECT * FROM VALUES {rows}").selectExpr(*expressions).collect()]

    return evaluate
