"""Customer segment rules."""

from __future__ import annotations

from orderloom.schema import SEGMENT_RULES, SEGMENTS


def _first_match(conditions: list[tuple[str, str]]) -> str:
    arms = " ".join(f"WHEN {condition} THEN '{segment}'" for condition, segment in conditions)
    return f"CASE {arms} ELSE '{SEGMENTS[-1]}' END"


def segment_by_spend_and_frequency(monetary: str, frequency: str) -> str:
    """Both thresholds of a rule must hold, else the next rule is tried."""
    return _first_match(
        [(f"{monetary} > {spend} AND {frequency} >= {orders}", segment) for segment, spend, orders in SEGMENT_RULES]
    )


def segment_by_spend(spend_total: str) -> str:
    """Spend thresholds only."""
    return _first_match([(f"{spend_total} > {spend}", segment) for segment, spend, _ in SEGMENT_RULES])
