"""Schemas, column lists and fill values of the two raw inputs.

Every raw column is read as a nullable string; typed values are produced by
named conversions in ``storelens.functions`` so that no type depends on which
values one file happens to hold.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# ---------------------------------------------------------------------------

# Header of the app-listing CSV, in file order.
APPS_CSV_HEADER = (
    "App", "Category", "Rating", "Reviews", "Size", "Installs", "Type", "Price",
    "Content Rating", "Genres", "Last Updated", "Current Ver", "Android Ver",
)

# Header names that are renamed after reading.
APPS_RENAME = {
    "Content Rating": "Content_Rating",
    "Last Updated": "Last_Updated",
    "Current Ver": "Current_Ver",
    "Android Ver": "Android_Ver",
}

# Column order of the cleaned / landed app table.
APPS_COLUMNS = (
    "App", "Category", "Rating", "Reviews", "Size", "Installs", "Type", "Price",
    "Content_Rating", "Genres", "Last_Updated", "Current_Ver", "Android_Ver",
)

# Fill values for missing app fields (Rating is numeric, the rest text).
APPS_FILL = {
    "Rating": 0.0,
    "Reviews": "0",
    "Size": "Varies with device",
    "Type": "Free",
    "Price": "0",
    "Content_Rating": "Everyone",
    "Genres": "Unknown",
    "Last_Updated": "Unknown",
    "Current_Ver": "Varies with device",
    "Android_Ver": "Varies with device",
    "Category": "UNKNOWN",
}

# Review CSV header, in file order.
REVIEWS_COLUMNS = (
    "App", "Translated_Review", "Sentiment", "Sentiment_Polarity",
    "Sentiment_Subjectivity",
)

# Fill values for missing review fields; the scores stay text until staging
# so that a malformed score becomes NULL there instead of a silent 0.
REVIEWS_FILL = {
    "Sentiment": "Neutral",
    "Sentiment_Polarity": "0.0",
    "Sentiment_Subjectivity": "0.0",
}

# Missing-value tokens recognised by a pandas CSV read with default options
# (exact, case-sensitive match of the whole field, no trimming).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Token written for missing values in exported CSV files.
CSV_NULL_TOKEN = "NULL"

# Sentiment labels and their scores (compared lower-cased).
SENTIMENT_SCORES = (("positive", 1.0), ("neutral", 0.5), ("negative", 0.0))

# Size text that means "no size".
SIZE_VARIES = "Varies with device"

# Placeholder for NULL inside surrogate-key concatenation.
KEY_NULL = "_"

# ---------------------------------------------------------------------------


def all_strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


APPS_RAW = all_strings(APPS_CSV_HEADER)
APPS_RENAMED = all_strings(APPS_COLUMNS)
REVIEWS_RAW = all_strings(REVIEWS_COLUMNS)

# Typed schema of the cleaned app table (the landing table's DDL).
APPS_CLEAN = T.StructType([
    T.StructField("App", T.StringType(), True),
    T.StructField("Category", T.StringType(), True),
    T.StructField("Rating", T.DoubleType(), True),
    T.StructField("Reviews", T.StringType(), True),
    T.StructField("Size", T.StringType(), True),
    T.StructField("Installs", T.LongType(), True),
    T.StructField("Type", T.StringType(), True),
    T.StructField("Price", T.DoubleType(), True),
    T.StructField("Content_Rating", T.StringType(), True),
    T.StructField("Genres", T.StringType(), True),
    T.StructField("Last_Updated", T.StringType(), True),
    T.StructField("Current_Ver", T.StringType(), True),
    T.StructField("Android_Ver", T.StringType(), True),
])

REVIEWS_CLEAN = REVIEWS_RAW
