"""Data-quality checks and column guards.

Each check returns the failing rows as a DataFrame (empty = pass), so it runs
distributed and can be counted, shown or written like any dataset.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.sql import ident


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs ignored):
    columns ``unique_field``, ``n_records``."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def suite(df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = ()) -> DataFrame:
    """All checks of a table in one scan, as the project's schema file declares
    them: rows (check, column, failures, passed).  ``unique`` counts the values
    that occur more than once (NULLs ignored), ``not_null`` the NULL rows.

    The conditional counts and every unique key share one Expand and one
    shuffle: a row stands once per key, dealt by (check, value), and repeats
    collapse before the shuffle."""
    if not unique and not not_null:
        raise ValueError("no checks")
    keys = [F.struct(F.lit(i).alias("k"), F.col(ident(c)).cast("string").alias("v"), F.lit(0).cast("long").alias("bad"))
            for i, c in enumerate(unique)]
    nulls = [F.struct(F.lit(len(unique) + i).alias("k"), F.lit(None).cast("string").alias("v"),
                      F.col(ident(c)).isNull().cast("long").alias("bad")) for i, c in enumerate(not_null)]
    n = len(unique)
    per_value = (df.select(F.explode(F.array(*keys, *nulls)).alias("e")).select("e.*")
                 .groupBy("k", "v").agg(F.count(F.lit(1)).alias("rows"), F.sum("bad").alias("bad")))
    names = F.array(*[F.lit(x) for x in (*unique, *not_null)])
    return (per_value.groupBy("k").agg(
        F.sum(F.when(F.col("k") >= n, F.col("bad"))
              .when(F.col("v").isNotNull() & (F.col("rows") > 1), 1).otherwise(0)).alias("failures"))
        .select(F.when(F.col("k") < n, "unique").otherwise("not_null").alias("check"),
                F.get(names, F.col("k")).alias("column"), "failures",
                (F.col("failures") == 0).alias("passed")))


def is_empty(df: DataFrame) -> bool:
    """True when the frame has no rows (reads at most one row)."""
    return df.isEmpty()


def has_columns(df: DataFrame, columns: Iterable[str]) -> bool:
    return set(columns) <= set(df.columns)


def default_for(name: str):
    """Default value and type for a required column that is absent.

    Rule, checked in this order on the column name: contains 'rating',
    'price' or 'size' -> 0.0; contains 'installs' or 'reviews' -> 0;
    exactly 'category_name' -> 'Unknown'; otherwise NULL text.
    """
    if any(part in name for part in ("rating", "price", "size")):
        return 0.0, T.DoubleType()
    if any(part in name for part in ("installs", "reviews")):
        return 0, T.LongType()
    if name == "category_name":
        return "Unknown", T.StringType()
    return None, T.StringType()


def ensure_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add every absent required column with its default (``default_for``)."""
    missing = [c for c in required if c not in df.columns]
    if not missing:
        return df
    add = {}
    for c in missing:
        value, dtype = default_for(c)
        add[c] = F.lit(value).cast(dtype)
    return df.withColumns(add)
