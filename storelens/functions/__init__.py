"""Conversions, each defined once as a SQL template (``*_sql``: SQL text in,
SQL text out, for composing inside plans) and exposed as a Column function
taking column names.  No Python UDFs anywhere."""

from storelens.functions.dates import iso_date, iso_date_sql, parse_date, parse_date_sql
from storelens.functions.display import (
    compact_number,
    compact_number_sql,
    thousands,
    thousands_sql,
)
from storelens.functions.keys import md5_key, md5_key_sql
from storelens.functions.numeric import (
    bytes_to_mb,
    bytes_to_mb_sql,
    installs_text,
    installs_text_sql,
    installs_to_long,
    installs_to_long_sql,
    is_digits,
    is_digits_sql,
    nan_to_null,
    nan_to_null_sql,
    number_or_zero,
    number_or_zero_sql,
    price_to_number,
    price_to_number_sql,
    size_to_bytes,
    size_to_bytes_sql,
    text_score,
    text_score_sql,
    to_number,
    to_number_sql,
)
from storelens.functions.sentiment import sentiment_score, sentiment_score_sql
from storelens.functions.sql import ident, lit
from storelens.functions.text import na_to_null, na_to_null_sql, strip_ws, strip_ws_sql

__all__ = [
    "bytes_to_mb", "bytes_to_mb_sql", "compact_number", "compact_number_sql",
    "ident", "installs_text", "installs_text_sql", "installs_to_long",
    "installs_to_long_sql", "is_digits", "is_digits_sql", "iso_date",
    "iso_date_sql", "lit", "md5_key", "md5_key_sql", "na_to_null",
    "na_to_null_sql", "nan_to_null", "nan_to_null_sql", "number_or_zero",
    "number_or_zero_sql", "parse_date", "parse_date_sql", "price_to_number",
    "price_to_number_sql", "sentiment_score", "sentiment_score_sql",
    "size_to_bytes", "size_to_bytes_sql", "strip_ws", "strip_ws_sql",
    "text_score", "text_score_sql", "thousands", "thousands_sql",
    "to_number", "to_number_sql",
]
