"""Column layouts of the stored tables and the fixed business values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Money is stored as an exact decimal with two places; see functions/money.py.
MONEY = DecimalType(18, 2)
# A price keeps finer places: amounts are rounded once, after multiplying.
PRICE = DecimalType(18, 6)

BRONZE = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_id", StringType()),
        StructField("category", StringType()),
        StructField("order_date", DateType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", PRICE),
        StructField("discount_pct", IntegerType()),
        StructField("shipping_cost", MONEY),
        StructField("customer_rating", DoubleType()),
        StructField("payment_method", StringType()),
        StructField("city", StringType()),
        StructField("status", StringType()),
        StructField("return_reason", StringType()),
    ]
)

SILVER = StructType(
    BRONZE.fields
    + [
        StructField("gross_amount", MONEY),
        StructField("discount_amount", MONEY),
        StructField("net_amount", MONEY),
        StructField("total_amount", MONEY),
        StructField("order_year", IntegerType()),
        StructField("order_month", IntegerType()),
        StructField("order_quarter", IntegerType()),
        StructField("order_day_name", StringType()),
        StructField("is_weekend", BooleanType()),
        StructField("is_returned", BooleanType()),
    ]
)

# Order states, fill constants and weekend days.
CANCELLED = "cancelled"
RETURNED = "returned"
NO_RETURN = "No Return"
NO_RATING = 0.0
WEEKEND_DAYS = ("Saturday", "Sunday")

# Accepted lists of the column tests.
ACCEPTED_STATUSES = ("delivered", "shipped", "returned", "pending")
ACCEPTED_CATEGORIES = (
    "Electronics",
    "Fashion",
    "Home & Garden",
    "Sports",
    "Books",
    "Beauty",
    "Toys",
    "Food & Beverage",
    "Automotive",
)
SEGMENTS = ("VIP", "Premium", "Regular", "New")

# Segment rules, tried in order; the last segment takes the rest.
# (segment, spend strictly above, order count at least)
SEGMENT_RULES = (("VIP", 2000, 5), ("Premium", 1000, 3), ("Regular", 500, 0))
