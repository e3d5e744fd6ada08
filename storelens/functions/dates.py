"""Date conversions."""

from __future__ import annotations

from collections.abc import Sequence

from storelens.functions.sql import as_column, lit, regex

ISO_DATE_RE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"


def iso_date_sql(x: str) -> str:
    """'2018-08-01' -> date; anything else (incl. 'January 7, 2018',
    '2018', '2018-13-01') -> NULL.  A cast, not a parse."""
    return f"CASE WHEN {x} RLIKE {regex(ISO_DATE_RE)} THEN try_cast({x} AS DATE) END"


def parse_date_sql(x: str, formats: Sequence[str] = ("yyyy-MM-dd", "MMMM d, yyyy")) -> str:
    """First format that parses wins; NULL when none does."""
    return "coalesce(" + ", ".join(f"try_to_date({x}, {lit(f)})" for f in formats) + ")"


iso_date = as_column(iso_date_sql)
parse_date = as_column(parse_date_sql)
