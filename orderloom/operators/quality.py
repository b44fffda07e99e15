"""Data-quality checks.

Two families:

* expectations: scalar checks, one row each of
  ``(check_name, got, expected, passed)``;
* column tests: declared rules ``not_null``, ``unique`` and ``accepted_values``,
  one row each of ``(test, model, column_name, failures, passed)``, where
  ``failures`` counts failing rows, failing keys or failing values.

Every check yields a row whether it passes or not, and all checks of one table
that need no grouping share one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.money import sum_money
from orderloom.schema import ACCEPTED_CATEGORIES, CANCELLED, SEGMENTS


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# -- expectations ---------------------------------------------------------


def scalar_checks(table: DataFrame, checks: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Evaluate aggregates over a table, all in one scan.

    ``checks`` maps a name to (aggregate, expected value). A NULL result is a
    failure, not an unknown.
    """
    measured = table.agg(*[F.expr(f"CAST({sql} AS BIGINT) AS v{i}") for i, (sql, _) in enumerate(checks.values())])
    rows = ", ".join(f"{_text(name)}, v{i}, {expected}L" for i, (name, (_, expected)) in enumerate(checks.items()))
    return measured.selectExpr(f"stack({len(checks)}, {rows}) AS (check_name, got, expected)").selectExpr(
        "*", "got <=> expected AS passed"
    )


_OFFENDING = {
    "no_negative_price": "unit_price < 0",
    "no_zero_quantity": "quantity = 0",
    "no_missing_customer": "customer_id IS NULL",
    "no_cancelled_order": f"status = {_text(CANCELLED)}",
    "no_negative_total": "total_amount < 0",
}


def order_expectations(orders: DataFrame, strict: bool = False) -> DataFrame:
    """Row-level promises of silver, each a count of offending rows.

    ``strict`` also refuses prices and totals of exactly zero.
    """
    offending = dict(_OFFENDING)
    if strict:
        offending |= {"price_above_zero": "unit_price <= 0", "total_above_zero": "total_amount <= 0"}
    return scalar_checks(orders, {name: (f"count_if({rule})", 0) for name, rule in offending.items()})


def orders_profile(orders: DataFrame, not_null: Iterable[str], *more: Column) -> DataFrame:
    """Offending rows and NULLs per category, city, status and ``more``, in one scan.

    Row-level promises, NULL counts, accepted statuses and distinct categories and
    cities all follow from this table, which combines on the map side.
    """
    counts = [F.expr(f"count_if({rule}) AS {name}") for name, rule in _OFFENDING.items()]
    nulls = [F.expr(f"count_if({c} IS NULL) AS null_{c}") for c in dict.fromkeys(not_null)]
    return orders.groupBy("category", "city", "status", *more).agg(F.expr("count(*) AS orders"), *counts, *nulls)


def profiled_expectations(profile: DataFrame) -> DataFrame:
    """``order_expectations`` from a profile."""
    return scalar_checks(profile, {name: (f"coalesce(sum({name}), 0)", 0) for name in _OFFENDING})


def reconciliation(
    silver: DataFrame,
    gold_categories: DataFrame,
    gold_cities: DataFrame,
    gold_segments: DataFrame,
    expected_segments: int = len(SEGMENTS),
) -> DataFrame:
    """Gold row counts against the distinct values in silver, and the number of
    segments against the rule list.

    Both sides are one-row aggregates; they meet in a union grouped by check
    name, so no table is joined to another.
    """
    # The pairs are few, so two distinct counts over them cost nothing; over silver itself
    # they would expand every row. The filter keeps the optimizer from taking the grouping
    # out, as it does where only distinct values follow.
    pairs = silver.groupBy("category", "city").agg(F.expr("count(*) AS orders")).where("orders > 0")
    in_silver = pairs.agg(F.expr("count(DISTINCT category) AS v0"), F.expr("count(DISTINCT city) AS v1")).selectExpr(
        "stack(2, 'categories_match_silver', v0, 'cities_match_silver', v1) AS (check_name, expected)"
    )

    def got(name: str, table: DataFrame, measure: str, expected: str = "CAST(NULL AS BIGINT)") -> DataFrame:
        return table.agg(F.expr(f"{measure} AS got")).selectExpr(
            f"{_text(name)} AS check_name", "got", f"{expected} AS expected"
        )

    sides = [
        in_silver.selectExpr("check_name", "CAST(NULL AS BIGINT) AS got", "expected"),
        got("categories_match_silver", gold_categories, "count(*)"),
        got("cities_match_silver", gold_cities, "count(*)"),
        got("all_segments_present", gold_segments, "count(DISTINCT customer_segment)", f"{expected_segments}L"),
    ]
    return (
        union_all(sides)
        .groupBy("check_name")
        .agg(F.expr("max(got) AS got"), F.expr("max(expected) AS expected"))
        .selectExpr("*", "got <=> expected AS passed")
    )


def fixed_counts(
    gold_categories: DataFrame,
    gold_segments: DataFrame,
    expected_categories: int = len(ACCEPTED_CATEGORIES),
    expected_segments: int = len(SEGMENTS),
) -> DataFrame:
    """Gold row counts against fixed numbers, where the values are known beforehand."""
    return union_all(
        [
            scalar_checks(gold_categories, {"category_count": ("count(*)", expected_categories)}),
            scalar_checks(gold_segments, {"segment_count": ("count(DISTINCT customer_segment)", expected_segments)}),
        ]
    )


def total_revenue(gold_categories: DataFrame) -> DataFrame:
    """Revenue over all categories: one row."""
    return gold_categories.agg(F.expr(f"{sum_money('total_revenue')} AS total_revenue"))


# -- column tests ---------------------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    test: str  # not_null, unique or accepted_values
    model: str
    column: str
    accepted: tuple[str, ...] = ()


def null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures): NULLs per column, in one scan."""
    counts = table.agg(*[F.expr(f"count_if({c} IS NULL) AS v{i}") for i, c in enumerate(columns)])
    rows = ", ".join(f"{_text(c)}, v{i}" for i, c in enumerate(columns))
    return counts.selectExpr(f"stack({len(columns)}, {rows}) AS (column_name, failures)")


def duplicate_keys(table: DataFrame, column: str) -> DataFrame:
    """(column, occurrences) of every value that repeats; NULLs are not keys.

    Repeats are counted on the map side first, so a value that fills a large
    part of the table is still one small row per map task.
    """
    return (
        table.where(f"{column} IS NOT NULL")
        .groupBy(column)
        .agg(F.expr("count(*) AS occurrences"))
        .where("occurrences > 1")
    )


def unaccepted_values(table: DataFrame, column: str, accepted: Iterable[str]) -> DataFrame:
    """(column, occurrences) of every value outside the list; NULL passes."""
    values = ", ".join(_text(value) for value in accepted)
    return table.where(f"{column} NOT IN ({values})").groupBy(column).agg(F.expr("count(*) AS occurrences"))


def _failing_values(test: ColumnTest) -> str:
    """Number of distinct values outside a test's list, as an aggregate."""
    values = ", ".join(_text(value) for value in test.accepted)
    return f"count(DISTINCT CASE WHEN {test.column} NOT IN ({values}) THEN {test.column} END)"


def repeated_keys(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, failures): how many values repeat, per column that has such; NULLs are not keys.

    All columns of a table take one scan and one shuffle: a row is a key per column, and
    the keys are counted on the map side first.
    """
    keys = ", ".join(f"{_text(c)}, CAST({c} AS STRING)" for c in columns)
    found = table.selectExpr(f"stack({len(list(columns))}, {keys}) AS (column_name, key)").where("key IS NOT NULL")
    counted = found.groupBy("column_name", "key").agg(F.expr("count(*) AS occurrences")).where("occurrences > 1")
    return counted.groupBy("column_name").agg(F.expr("count(*) AS failures"))


def run_column_tests(
    tables: Mapping[str, DataFrame], tests: Iterable[ColumnTest], profiles: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per declared test over the named tables.

    Models given as the same frame are tested together: one scan for all their
    ``not_null`` and ``accepted_values`` tests, one scan and shuffle for all their unique
    columns, each looked at by itself. A model with a profile (``orders_profile``) is
    scanned for its unique columns only.
    """
    profiles = profiles or {}
    # frame -> (frame, {aggregate: tests it answers}, {unique column: tests})
    frames: dict[int, tuple[DataFrame, dict[str, list], dict[str, list]]] = {}
    for t in tests:
        profiled = t.model in profiles and t.test != "unique"
        table = profiles[t.model] if profiled else tables[t.model]
        _, scanned, unique = frames.setdefault(id(table), (table, {}, {}))
        if t.test == "not_null":
            nulls = f"coalesce(sum(null_{t.column}), 0)" if profiled else f"count_if({t.column} IS NULL)"
            scanned.setdefault(nulls, []).append(t)
        elif t.test == "accepted_values":
            scanned.setdefault(_failing_values(t), []).append(t)
        elif t.test == "unique":
            unique.setdefault(t.column, []).append(t)
        else:
            raise ValueError(f"unknown column test {t.test!r}")
    results = []
    for table, scanned, unique in frames.values():
        if scanned:
            results.append(_one_row_per_test(table, scanned))
        if unique:
            # Columns without a repeated value have no row.
            of = lambda c: f"coalesce(max(CASE WHEN column_name = {_text(c)} THEN failures END), 0)"
            repeated = repeated_keys(table, unique)
            results.append(_one_row_per_test(repeated, {of(column): answered for column, answered in unique.items()}))
    return union_all(results)


def _one_row_per_test(table: DataFrame, aggregates: Mapping[str, list[ColumnTest]]) -> DataFrame:
    counted = table.agg(*[F.expr(f"{sql} AS v{i}") for i, sql in enumerate(aggregates)])
    rows = [
        f"{_text(t.test)}, {_text(t.model)}, {_text(t.column)}, v{i}"
        for i, answered in enumerate(aggregates.values())
        for t in answered
    ]
    columns = "test, model, column_name, failures"
    return counted.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({columns})").selectExpr(
        "*", "failures = 0 AS passed"
    )


# -- gate -----------------------------------------------------------------


class QualityGateError(RuntimeError):
    """Some check failed; ``failed`` holds the failing rows."""

    def __init__(self, failed: list):
        self.failed = failed
        super().__init__("; ".join(str(row.asDict()) for row in failed))


def gate(checks: DataFrame) -> list:
    """Collect a check table (a few dozen rows by construction), raise if any
    check failed, else return its rows."""
    rows = checks.collect()
    failed = [row for row in rows if not row["passed"]]
    if failed:
        raise QualityGateError(failed)
    return rows
