"""Text-to-number conversions (SQL templates + Column versions).

Spark's ``try_cast`` accepts more than a plain decimal number ('19d' and '1f'
are Java float literals, '2018' is a date); every cast here is guarded by an
explicit pattern so that only plain decimal numbers convert.
"""

from __future__ import annotations

import sys

from storelens.functions.sql import as_column, lit, regex
from storelens.functions.text import strip_ws_sql

# A plain decimal number with optional sign, fraction and exponent; blanks
# around it are allowed.  'nan', 'inf', '1_000', '19d', '0x1A' do not match.
NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DIGITS_RE = r"^[0-9]+$"

MB = 1024 * 1024
KB = 1024


def finite_sql(x: str) -> str:
    """NaN and the infinities -> NULL on a double."""
    return f"CASE WHEN abs({x}) < CAST('Infinity' AS DOUBLE) THEN {x} END"


def to_number_sql(x: str, times: int = 1) -> str:
    """Double, ``times`` (a power of two) as large, or NULL when the text is
    not a plain number or too large for one.  The pattern is matched once."""
    most = f"CAST({sys.float_info.max / times!r} AS DOUBLE)"
    value = f"try_cast({x} AS DOUBLE)"
    return (f"CASE WHEN {x} RLIKE {regex(NUMBER_RE)} AND abs({value}) <= {most} "
            f"THEN {value}{'' if times == 1 else f' * {times}'} END")


def nan_to_null_sql(x: str) -> str:
    """NaN -> NULL on a double column."""
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


def installs_text_sql(x: str) -> str:
    """Installs text with ',' and '+' removed and surrounding blanks stripped."""
    return strip_ws_sql(f"translate(CAST({x} AS STRING), ',+', '')")


def is_digits_sql(x: str) -> str:
    return f"({x} RLIKE {regex(DIGITS_RE)})"


def installs_to_long_sql(x: str) -> str:
    """Cleaned installs text -> bigint (0 when it does not fit)."""
    return f"coalesce(try_cast({x} AS BIGINT), 0L)"


def price_to_number_sql(x: str) -> str:
    """'$4.99' -> 4.99; anything that is not a number -> 0.0."""
    cleaned = strip_ws_sql(f"replace(CAST({x} AS STRING), '$', '')")
    return f"coalesce({to_number_sql(cleaned)}, CAST(0.0 AS DOUBLE))"


def size_to_bytes_sql(x: str, varies: str = "Varies with device") -> str:
    """'19M' -> 19 MiB, '8.5k' -> 8.5 KiB, anything else -> NULL.

    Suffixes are case-sensitive; every 'M' (or 'k') in the text is removed
    before the number is read.
    """
    mega = to_number_sql(f"replace({x}, 'M', '')", MB)
    kilo = to_number_sql(f"replace({x}, 'k', '')", KB)
    return (f"CASE WHEN {x} = {lit(varies)} THEN CAST(NULL AS DOUBLE) "
            f"WHEN {x} LIKE '%M' THEN {mega} "
            f"WHEN {x} LIKE '%k' THEN {kilo} "
            f"ELSE CAST(NULL AS DOUBLE) END")


def text_score_sql(x: str, null_token: str = "NULL") -> str:
    """Score stored as text: the NULL token and malformed text -> NULL."""
    return to_number_sql(f"nullif(CAST({x} AS STRING), {lit(null_token)})")


def bytes_to_mb_sql(x: str) -> str:
    """Bytes -> MiB; a missing, NaN or infinite size counts as 0."""
    v = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN {v} IS NULL OR isnan({v}) OR abs({v}) = CAST('Infinity' AS DOUBLE) "
            f"THEN CAST(0.0 AS DOUBLE) ELSE {v} / CAST({MB} AS DOUBLE) END")


def number_or_zero_sql(x: str) -> str:
    """Numeric value for plotting: non-numeric / missing text -> 0.0."""
    return f"coalesce({to_number_sql(f'CAST({x} AS STRING)')}, CAST(0.0 AS DOUBLE))"


to_number = as_column(to_number_sql)
nan_to_null = as_column(nan_to_null_sql)
installs_text = as_column(installs_text_sql)
is_digits = as_column(is_digits_sql)
installs_to_long = as_column(installs_to_long_sql)
price_to_number = as_column(price_to_number_sql)
size_to_bytes = as_column(size_to_bytes_sql)
text_score = as_column(text_score_sql)
bytes_to_mb = as_column(bytes_to_mb_sql)
number_or_zero = as_column(number_or_zero_sql)
