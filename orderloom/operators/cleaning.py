"""Silver steps: drop rows that cannot be trusted, fill gaps, derive columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import day_name, is_weekend, period_parts
from orderloom.functions.money import divide_half_up, from_cents, price_times, to_cents
from orderloom.schema import BRONZE, CANCELLED, NO_RATING, NO_RETURN, RETURNED


def _valid(orders: DataFrame) -> str:
    valid = f"unit_price > 0 AND quantity > 0 AND NOT (status <=> '{CANCELLED}')"
    if dict(orders.dtypes)["unit_price"] in ("double", "float"):
        # Spark orders NaN above every number, so "> 0" alone would keep it.
        valid += " AND NOT isnan(unit_price)"
    return valid


def keep_valid(orders: DataFrame) -> DataFrame:
    """Positive price and quantity, not cancelled.

    Missing prices and quantities go; a missing status stays.
    """
    return orders.where(_valid(orders))


def fill_missing(orders: DataFrame) -> DataFrame:
    """Rating NULL or NaN becomes 0.0, return reason NULL becomes 'No Return'."""
    rating = f"nanvl(coalesce(CAST(customer_rating AS DOUBLE), {NO_RATING}D), {NO_RATING}D)"
    return orders.withColumns(
        {"customer_rating": F.expr(rating), "return_reason": F.expr(f"coalesce(return_reason, '{NO_RETURN}')")}
    )


def add_amounts(orders: DataFrame) -> DataFrame:
    """gross, discount, net and total amount, worked out in whole cents.

    The price is multiplied before it is rounded. A NaN price or shipping cost counts
    as missing: the amounts that need it are NULL.
    """
    return orders.selectExpr(
        "*",
        f"{price_times('unit_price', 'quantity')} AS _gross",
        f"{divide_half_up('_gross * discount_pct', '100')} AS _discount",
        f"{from_cents('_gross')} AS gross_amount",
        f"{from_cents('_discount')} AS discount_amount",
        f"{from_cents('_gross - _discount')} AS net_amount",
        f"{from_cents(f'_gross - _discount + ({to_cents('shipping_cost')})')} AS total_amount",
    ).drop("_gross", "_discount")


def add_calendar(orders: DataFrame) -> DataFrame:
    """order_date as a date, its year, month, quarter and day name, weekend flag."""
    day = "CAST(order_date AS DATE)"
    derived = {
        "order_date": day,
        **period_parts(day),
        "order_day_name": day_name(day),
        "is_weekend": is_weekend(day),
    }
    return orders.withColumns({name: F.expr(sql) for name, sql in derived.items()})


def add_flags(orders: DataFrame) -> DataFrame:
    """is_returned; a missing status is False, never NULL."""
    return orders.withColumn("is_returned", F.expr(f"status <=> '{RETURNED}'"))


def clean_orders(bronze: DataFrame) -> DataFrame:
    """Bronze rows to silver rows. One pass, no shuffle."""
    return (
        bronze.transform(keep_valid)
        .transform(fill_missing)
        .transform(add_amounts)
        .transform(add_calendar)
        .transform(add_flags)
    )


def by_bronze_names(orders: DataFrame) -> DataFrame:
    """The columns of bronze, found by name in any order and case, with their own types.

    A column that bronze doesn't have is an error, since its values would be lost. One
    that bronze has and the batch doesn't is NULL.
    """
    given = {name.lower(): name for name in orders.columns}
    unknown = sorted(set(given) - set(BRONZE.fieldNames()))
    if unknown or len(given) < len(orders.columns):
        raise ValueError(f"columns that bronze does not have, or repeated ones: {unknown or orders.columns}")
    return orders.selectExpr(
        *[
            f"`{given[f.name]}` AS {f.name}" if f.name in given else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
            for f in BRONZE.fields
        ]
    )


def as_bronze(orders: DataFrame) -> DataFrame:
    """Any order frame in the bronze layout (see ``by_bronze_names``), NaN as NULL where
    the stored type has no NaN."""
    orders = by_bronze_names(orders)
    given = dict(orders.dtypes)
    columns = []
    for field in BRONZE.fields:
        stored = field.dataType.simpleString()
        value = field.name
        if given[value] in ("double", "float") and stored != "double":
            value = f"nanvl({value}, NULL)"
            if given[field.name] == "float" and stored.startswith("decimal"):
                # The digits a float was written with, not those of its binary value.
                value = f"CAST({value} AS STRING)"
        columns.append(f"CAST({value} AS {stored}) AS {field.name}")
    return orders.selectExpr(*columns)


def drop_summary(bronze: DataFrame) -> DataFrame:
    """How many rows cleaning keeps and drops; the percentage has one place."""
    counts = bronze.agg(
        F.expr("count(*) AS original_rows"), F.expr(f"count_if({_valid(bronze)}) AS kept_rows")
    )
    tenths = divide_half_up("1000 * (original_rows - kept_rows)", "original_rows")
    return counts.selectExpr(
        "*", "original_rows - kept_rows AS dropped_rows", f"CAST({tenths} AS DOUBLE) / 10 AS dropped_pct"
    )
