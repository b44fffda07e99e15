from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.functions.money import to_cents
from orderloom.operators import cleaning, quality
from orderloom.operators.cleaning import as_bronze, clean_orders
from orderloom.operators.incremental import load_bronze
from orderloom.operators.staging import stg_orders
from orderloom.schema import BRONZE, SILVER
from orderloom.sources.lake import Lake
from tests.conftest import VALID_ORDER

FAULTS = {
    "c1": {},
    "c2": {"unit_price": Decimal("-5.00")},
    "c3": {"unit_price": Decimal("0.00")},
    "c4": {"unit_price": None},
    "c5": {"quantity": 0},
    "c6": {"quantity": None},
    "c7": {"status": "cancelled"},
    "c8": {"status": None},
    "c9": {"status": "returned"},
    "c10": {"customer_rating": None},
    "c11": {"customer_rating": float("nan")},
    "c12": {"order_date": None},
    "c13": {"customer_id": None},
}


@pytest.fixture(scope="module")
def faulty(bronze_rows):
    return bronze_rows(*[{**fault, "order_id": name} for name, fault in FAULTS.items()])


@pytest.fixture(scope="module")
def silver(faulty):
    return {r["order_id"]: r for r in cleaning.clean_orders(faulty).collect()}


def test_which_rows_survive(silver):
    assert set(silver) == {"c1", "c8", "c9", "c10", "c11", "c12", "c13"}


def test_fills(silver):
    assert silver["c10"]["customer_rating"] == 0.0
    assert silver["c11"]["customer_rating"] == 0.0
    assert silver["c1"]["customer_rating"] == 4.0
    assert silver["c9"]["return_reason"] == "No Return"


def test_flags_are_never_null(silver):
    assert [silver[k]["is_returned"] for k in ("c1", "c8", "c9")] == [False, False, True]
    undated = silver["c12"]
    assert undated["is_weekend"] is False
    assert [undated[c] for c in ("order_year", "order_month", "order_quarter", "order_day_name")] == [None] * 4


def test_missing_customer_is_kept_and_reported(faulty):
    checks = {r["check_name"]: r for r in quality.order_expectations(cleaning.clean_orders(faulty), strict=True).collect()}
    assert (checks["no_missing_customer"]["got"], checks["no_missing_customer"]["passed"]) == (1, False)
    assert all(r["passed"] for name, r in checks.items() if name != "no_missing_customer")


def test_silver_layout(faulty):
    got = cleaning.clean_orders(faulty)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in SILVER]


def test_nan_price_is_dropped_from_double_frames(faulty):
    doubles = faulty.withColumn("unit_price", F.col("unit_price").cast("double"))
    nan = doubles.where("order_id = 'c1'").withColumn("unit_price", F.lit(float("nan")))
    kept = cleaning.keep_valid(doubles.unionByName(nan.withColumn("order_id", F.lit("nan"))))
    assert "nan" not in {r["order_id"] for r in kept.collect()}
    assert "c1" in {r["order_id"] for r in kept.collect()}


def test_as_bronze_takes_any_case_and_order_and_turns_nan_into_null(spark):
    names = BRONZE.fieldNames()[::-1]
    row = {**VALID_ORDER, "unit_price": float("nan"), "shipping_cost": 1.1}
    frame = spark.createDataFrame([tuple(row[c] for c in names)], ", ".join(f"{c.upper()} {_type(c)}" for c in names))
    got = cleaning.as_bronze(frame)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert got.first()["unit_price"] is None
    assert got.first()["shipping_cost"] == Decimal("1.10")
    assert got.first()["order_id"] == "ORD-1"


def _type(column):
    return "DOUBLE" if column in ("unit_price", "shipping_cost") else BRONZE[column].dataType.simpleString()


AMOUNTS = [
    # price, quantity, percent, shipping, gross, discount, net, total
    ("10.00", 2, 10, "5.00", "20.00", "2.00", "18.00", "23.00"),
    ("0.50", 1, 1, "0.00", "0.50", "0.01", "0.49", "0.49"),
    ("19.99", 3, 15, "4.50", "59.97", "9.00", "50.97", "55.47"),
    ("100.00", 1, 0, "0.00", "100.00", "0.00", "100.00", "100.00"),
]


def _amounts(bronze_rows, rows):
    frame = bronze_rows(
        *[
            {"unit_price": Decimal(p), "quantity": q, "discount_pct": d, "shipping_cost": Decimal(s)}
            for p, q, d, s in rows
        ]
    )
    got = cleaning.add_amounts(frame).select("gross_amount", "discount_amount", "net_amount", "total_amount")
    return [tuple(r) for r in got.collect()]


def test_amount_rows(bronze_rows):
    expected = [tuple(Decimal(v) for v in row[4:]) for row in AMOUNTS]
    assert _amounts(bronze_rows, [row[:4] for row in AMOUNTS]) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(-99999, 99999999), st.integers(0, 99), st.integers(0, 100), st.integers(0, 9999)),
        min_size=1,
        max_size=30,
    )
)
def test_amounts_equal_decimal_arithmetic(bronze_rows, rows):
    cent = Decimal("0.01")
    expected, given_rows = [], []
    for price_cents, quantity, percent, shipping_cents in rows:
        price, shipping = price_cents * cent, shipping_cents * cent
        gross = price * quantity
        discount = (gross * percent / 100).quantize(cent, ROUND_HALF_UP)
        expected.append((gross, discount, gross - discount, gross - discount + shipping))
        given_rows.append((price, quantity, percent, shipping))
    assert _amounts(bronze_rows, given_rows) == expected


def test_missing_discount_gives_missing_amounts(bronze_rows):
    row = cleaning.add_amounts(bronze_rows({"discount_pct": None})).first()
    assert (row["gross_amount"], row["net_amount"], row["total_amount"]) == (Decimal("10.00"), None, None)


def test_drop_summary(faulty):
    assert tuple(cleaning.drop_summary(faulty).first()) == (13, 7, 6, 46.2)


def test_drop_summary_of_nothing(faulty):
    assert tuple(cleaning.drop_summary(faulty.where("false")).first()) == (0, 0, 0, None)


def test_calendar_accepts_text_and_timestamps(spark):
    frame = spark.sql("SELECT '2024-01-06' AS order_date")
    for cast in ("string", "timestamp", "timestamp_ntz", "date"):
        row = cleaning.add_calendar(frame.withColumn("order_date", F.col("order_date").cast(cast))).first()
        assert (row["order_date"], row["order_day_name"], row["is_weekend"]) == (date(2024, 1, 6), "Saturday", True)


def test_staging_is_silver_plus_key(faulty):
    silver = cleaning.clean_orders(faulty)
    staged = stg_orders(silver)
    assert staged.columns == ["order_sk", *SILVER.fieldNames()]
    assert staged.where("order_id = 'c1'").first()["order_sk"] == "a9f7e97965d6cf799a529102a973b8b9"


@pytest.mark.parametrize("price_type", ["DECIMAL(18, 6)", "DOUBLE", "DECIMAL(10, 3)"])
@pytest.mark.parametrize("price, quantity, gross", [("1.005", 3, "3.02"), ("0.004", 1, "0.00"), ("0.005", 1, "0.01"), ("19.99", 3, "59.97")])
def test_a_price_finer_than_a_cent_is_multiplied_first(spark, tmp_path, bronze_rows, price_type, price, quantity, gross):
    raw = bronze_rows({"quantity": quantity}).withColumn("unit_price", F.expr(f"CAST({price}BD AS {price_type})"))
    direct = clean_orders(raw).first()
    lake = Lake(spark, str(tmp_path / "lake"))
    load_bronze(lake, as_bronze(raw))
    stored = clean_orders(lake.bronze()).first()
    assert direct["gross_amount"] == stored["gross_amount"] == Decimal(gross)


def test_nan_money_is_missing(bronze_rows):
    raw = bronze_rows({}).withColumn("shipping_cost", F.expr("CAST('NaN' AS DOUBLE)")).withColumn("unit_price", F.expr("10.0D"))
    row = clean_orders(raw).first()
    assert row["gross_amount"] == Decimal("10.00") and row["total_amount"] is None


@pytest.mark.parametrize("kind", ["DOUBLE", "DECIMAL(18, 2)"])
@pytest.mark.parametrize("amount", ["19999999999999.56", "20000000000000.56", "2000000000000.01", "-20000000000000.56"])
def test_cents_on_both_sides_of_the_double_bound(spark, kind, amount):
    cents = spark.range(1).selectExpr(f"CAST({amount}BD AS {kind}) AS x").selectExpr(f"{to_cents('x')} AS c").first()["c"]
    assert cents == int(Decimal(amount) * 100)
