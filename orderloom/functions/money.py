"""Exact money arithmetic on whole cents.

Binary floating sums depend on the order in which tasks finish, so two runs of
the same query could differ in the last place. Everything here adds BIGINT
cents instead: exact, order-independent, and about half the cost per row of
summing DECIMAL(18,2), whose buffer would be an uncompact DECIMAL(28,2).

Rounding is half away from zero.
"""

from __future__ import annotations

# Below this many units a double holds whole units with room to spare, so the fast
# path is exact. Larger amounts (table totals, not order lines) go through decimals.
_DOUBLE_IS_EXACT = 2e15

_MICROS_PER_CENT = 10_000


def _to_units(amount: str, per_one: int) -> str:
    """Amount to BIGINT units, rounded where it is finer than one; NaN is NULL.

    Both branches round, so a double and a decimal of the same digits agree.
    """
    double = f"CAST({amount} AS DOUBLE)"
    return (
        f"CASE WHEN abs({double}) <= {_DOUBLE_IS_EXACT / per_one}D"
        f" THEN CAST(rint({double} * {per_one}) AS BIGINT)"
        f" WHEN NOT isnan({double})"
        f" THEN CAST(round(CAST({amount} AS DECIMAL(38, 8)) * {per_one}) AS BIGINT) END"
    )


def to_cents(amount: str) -> str:
    """Amount with two decimal places to BIGINT cents, exactly; NaN is NULL."""
    return _to_units(amount, 100)


def price_times(price: str, quantity: str) -> str:
    """Cents of price * quantity, rounded once; prices count to six places."""
    return divide_half_up(f"({_to_units(price, 100 * _MICROS_PER_CENT)}) * {quantity}", str(_MICROS_PER_CENT))


def from_cents(cents: str) -> str:
    """BIGINT cents to the stored money type."""
    return f"CAST(({cents}) * 0.01BD AS DECIMAL(18, 2))"


def to_hundredths(value: str) -> str:
    """Small two-place measure (a rating) to whole hundredths."""
    return f"CAST(rint(CAST({value} AS DOUBLE) * 100) AS BIGINT)"


def divide_half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero denominator.

    The denominator must not be negative (it is a count everywhere here).
    """
    half = f"CASE WHEN ({numerator}) < 0 THEN -({denominator}) ELSE {denominator} END"
    return f"((2 * ({numerator}) + {half}) DIV nullif(2 * ({denominator}), 0))"


def sum_money(amount: str) -> str:
    """SUM of an amount column as money."""
    return from_cents(f"sum({to_cents(amount)})")


def mean_money(amount: str) -> str:
    """AVG of an amount column, rounded to cents. NULLs do not count, as in AVG."""
    return from_cents(divide_half_up(f"sum({to_cents(amount)})", f"count({amount})"))


def mean_2dp(value: str) -> str:
    """AVG of a small measure, rounded to two places, as DOUBLE."""
    return f"CAST({divide_half_up(f'sum({to_hundredths(value)})', f'count({value})')} AS DOUBLE) / 100"


def percent_2dp(part: str, whole: str) -> str:
    """100 * part / whole rounded to two places, as DOUBLE; NULL for a zero whole."""
    return f"CAST({divide_half_up(f'10000 * ({part})', whole)} AS DOUBLE) / 100"
