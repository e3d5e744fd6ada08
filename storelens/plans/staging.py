"""Staging models (M3, M4): renamed, typed, keyed.  No dedup here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from storelens.functions import (
    ident,
    iso_date_sql,
    md5_key_sql,
    size_to_bytes_sql,
    text_score_sql,
    to_number_sql,
)
from storelens.functions.sql import select_sql
from storelens.sources.csv import POSITION


def _double(df: DataFrame, name: str) -> str:
    """A numeric column as double; text (e.g. read back from CSV) is parsed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_number_sql(ident(name))
    return f"CAST({ident(name)} AS DOUBLE)"


def _bigint(df: DataFrame, name: str) -> str:
    c = ident(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return f"CASE WHEN {c} RLIKE r'^\\s*[+-]?[0-9]+\\s*$' THEN try_cast({c} AS BIGINT) END"
    return f"CAST({c} AS BIGINT)"


def stg_apps(clean: DataFrame) -> DataFrame:
    """Landed apps -> staging: sizes in bytes, ISO dates, row key
    md5(App‖Last_Updated‖Current_Ver) over the raw texts."""
    installs = _bigint(clean, "Installs")
    place = [POSITION] if POSITION in clean.columns else []
    return select_sql(clean, [
                "`App` AS app_name",
                "`Category` AS app_category",
                f"{_double(clean, 'Rating')} AS app_rating",
                "`Reviews` AS reviews_text",
                f"{size_to_bytes_sql('`Size`')} AS app_size_bytes",
                f"{installs} AS installs_int",
                "`Type` AS app_type",
                f"{_double(clean, 'Price')} AS app_price",
                "`Content_Rating` AS content_rating",
                "`Genres` AS app_genres",
                f"{iso_date_sql('`Last_Updated`')} AS last_updated_date",
                "`Current_Ver` AS current_version",
                "`Android_Ver` AS android_version",
                f"{md5_key_sql('`App`', '`Last_Updated`', '`Current_Ver`')} AS source_unique_key",
                *place,
            ], where=f"`App` IS NOT NULL AND {installs} IS NOT NULL")


def stg_reviews(clean: DataFrame) -> DataFrame:
    """Landed reviews -> staging: scores as doubles (NULL token or malformed
    text -> NULL), row key md5(App‖Translated_Review)."""
    return select_sql(clean, [
                "`App` AS app_name",
                "`Translated_Review` AS review_text",
                "`Sentiment` AS review_sentiment",
                f"{text_score_sql('`Sentiment_Subjectivity`')} AS subjectivity",
                f"{text_score_sql('`Sentiment_Polarity`')} AS polarity",
                f"{md5_key_sql('`App`', '`Translated_Review`')} AS source_unique_key",
            ], where="`Translated_Review` IS NOT NULL")
