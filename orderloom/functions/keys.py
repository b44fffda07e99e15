"""Readable and surrogate keys."""

from __future__ import annotations


def padded_id(prefix: str, number: str, width: int) -> str:
    """``prefix`` + number, zero-padded to at least ``width`` digits, never cut."""
    digits = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest(length({digits}), {width}), '0'))"


def surrogate_key(key: str) -> str:
    """Lower-case hexadecimal md5 of a text key."""
    return f"md5(CAST({key} AS BINARY))"
