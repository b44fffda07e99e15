"""Date parts used for grouping by period."""

from __future__ import annotations

# English day names in the order of Spark's weekday() (0 = Monday).
_DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def period_parts(day: str) -> dict[str, str]:
    """order_year, order_month and order_quarter of a date."""
    return {"order_year": f"year({day})", "order_month": f"month({day})", "order_quarter": f"quarter({day})"}


def day_name(day: str) -> str:
    """English weekday name in full, whatever the locale."""
    names = ", ".join(f"'{name}'" for name in _DAY_NAMES)
    return f"elt(weekday({day}) + 1, {names})"


def is_weekend(day: str) -> str:
    """True on Saturday and Sunday; a missing day is False, never NULL."""
    return f"coalesce(weekday({day}) IN (5, 6), false)"


def week_label(day: str) -> str:
    """Monday-to-Sunday week of a date as ``first/last``."""
    monday = f"trunc({day}, 'WEEK')"
    return f"concat(CAST({monday} AS STRING), '/', CAST(date_add({monday}, 6) AS STRING))"
