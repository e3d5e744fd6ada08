"""Display text for KPI values."""

from __future__ import annotations

from storelens.functions.sql import as_column

# (divisor, suffix), largest first.
COMPACT_UNITS = ((1_000_000_000, "B"), (1_000_000, "M"), (1_000, "K"))


def thousands_sql(x: str) -> str:
    """1234567 -> '1,234,567'."""
    return f"format_number(CAST({x} AS BIGINT), 0)"


def _whole(n: str, d: int) -> str:
    """Integer quotient of a non-negative DECIMAL(38, 0); ``div`` returns BIGINT."""
    return f"CAST(({n} - {n} % {d}) / {d} AS DECIMAL(38, 0))"


def compact_number_sql(x: str) -> str:
    """Compact count text: >=1e9 'x.yB', >=1e6 'x.yM', >=1e3 'x.yK', else
    '1,234'-style.  The unit is chosen on the exact value, tenths are rounded
    half-up in integer arithmetic (no float formatting involved)."""
    n = f"CAST(floor({x}) AS DECIMAL(38, 0))"
    branches = []
    for divisor, suffix in COMPACT_UNITS:
        tenths = _whole(f"({n} + {divisor // 20})", divisor // 10)
        text = f"concat(CAST({_whole(tenths, 10)} AS STRING), '.', CAST({tenths} % 10 AS STRING), '{suffix}')"
        branches.append(f"WHEN {n} >= {divisor} THEN {text}")
    return f"CASE {' '.join(branches)} ELSE {thousands_sql(n)} END"


thousands = as_column(thousands_sql)
compact_number = as_column(compact_number_sql)
