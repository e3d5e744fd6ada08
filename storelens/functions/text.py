"""Small text helpers shared by the conversion functions."""

from __future__ import annotations

from collections.abc import Iterable

from storelens.functions.sql import as_column, in_list, regex


def strip_ws_sql(x: str) -> str:
    """Remove leading and trailing whitespace, Unicode blanks included."""
    return f"regexp_replace({x}, {regex(r'(?U)^\s+|\s+$')}, '')"


def na_to_null_sql(x: str, tokens: Iterable[str]) -> str:
    """NULL when the whole field equals one of the missing-value tokens."""
    return f"CASE WHEN {x} IN {in_list(tokens)} THEN NULL ELSE {x} END"


strip_ws = as_column(strip_ws_sql)
na_to_null = as_column(na_to_null_sql)
