"""Cleaning of the raw inputs into landing tables (M1, M2).

Both are narrow, per-row plans (one map-only codegen stage): NA tokens to
NULL, row filters, typed conversions, fill values — one filter and one
projection each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from storelens.functions import (
    ident,
    installs_text_sql,
    installs_to_long_sql,
    is_digits_sql,
    lit,
    na_to_null_sql,
    price_to_number_sql,
    to_number_sql,
)
from storelens.functions.sql import select_sql
from storelens.sources.csv import POSITION
from storelens.sources.schemas import APPS_COLUMNS, APPS_FILL, NA_TOKENS, REVIEWS_FILL


def _na_exprs(df: DataFrame, columns: Sequence[str], tokens: Sequence[str]) -> dict[str, str]:
    """SQL per column: missing-value tokens -> NULL on string columns."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return {c: na_to_null_sql(ident(c), tokens) if c in strings else ident(c) for c in columns}


def clean_apps(raw: DataFrame, na_tokens: Sequence[str] = NA_TOKENS,
               unrated_as_zero: bool = True) -> DataFrame:
    """Raw app listings -> typed landing rows (13 columns, ``APPS_COLUMNS``).

    * rows without App are dropped;
    * Installs: ',' and '+' removed, blanks stripped; rows whose result is
      not all digits are dropped, the rest become bigint;
    * Rating: plain number or NULL, then 0.0 when ``unrated_as_zero``;
    * text fields get their fill values (``APPS_FILL``), the rest '';
    * Price: '$' removed, number, anything else 0.0;
    * a source position (``sources.csv.POSITION``) is carried along.
    """
    na = _na_exprs(raw, APPS_COLUMNS, na_tokens)
    installs = installs_text_sql(na["Installs"])
    keep = f"{na['App']} IS NOT NULL AND {is_digits_sql(installs)}"

    def filled(c: str) -> str:
        return f"coalesce({na[c]}, {lit(APPS_FILL.get(c, ''))})"

    rating = to_number_sql(na["Rating"])
    if unrated_as_zero:
        rating = f"coalesce({rating}, {lit(float(APPS_FILL['Rating']))})"
    out = {c: filled(c) for c in APPS_COLUMNS}
    out.update({
        "Rating": rating,
        "Installs": installs_to_long_sql(installs),
        "Price": price_to_number_sql(filled("Price")),
    })
    place = [POSITION] if POSITION in raw.columns else []
    return select_sql(raw, [f"{e} AS {ident(c)}" for c, e in out.items()] + place, keep)


def clean_reviews(raw: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Raw reviews -> landing rows: rows missing App or review text are
    dropped; Sentiment defaults to 'Neutral', the two scores to '0.0' (kept as
    text — malformed scores are resolved in staging).  A store-assigned
    ``_id`` column is dropped when present."""
    raw = raw.drop("_id")
    na = _na_exprs(raw, raw.columns, na_tokens)
    keep = f"{na['App']} IS NOT NULL AND {na['Translated_Review']} IS NOT NULL"
    out = [f"coalesce({e}, {lit(REVIEWS_FILL[c])}) AS {ident(c)}" if c in REVIEWS_FILL
           else f"{e} AS {ident(c)}" for c, e in na.items()]
    return select_sql(raw, out, keep)
