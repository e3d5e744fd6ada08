"""SQL-text building blocks.

Every conversion in ``storelens.functions`` is defined once, as a SQL
expression template over the SQL text of its argument(s), and becomes a
Column with one ``F.expr`` call.  Plans compose the templates as text and
hand each finished output column to Spark in one ``selectExpr``, so a stage
costs a couple of driver->JVM calls instead of one per sub-expression; the
resulting Catalyst expressions are the same as with the Column API.

Regex patterns are raw string literals (``r'...'``), which assume the
default ``spark.sql.parser.escapedStringLiterals=false``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit(value) -> str:
    """A Python value as a SQL literal (strings, numbers, None)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, int):
        return f"{value}L" if abs(value) > 2**31 - 1 else str(value)
    s = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def regex(pattern: str) -> str:
    """A regex as a raw string literal (backslashes kept as written)."""
    if "'" in pattern:
        raise ValueError("regex literals must not contain a single quote")
    return f"r'{pattern}'"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def as_column(builder: Callable[..., str]) -> Callable[..., Column]:
    """Column version of a SQL-text builder: positional arguments are column
    names, keyword arguments are passed through."""
    def column_fn(*names: str, **kw) -> Column:
        return F.expr(builder(*[ident(n) for n in names], **kw))
    column_fn.__name__ = builder.__name__.removesuffix("_sql")
    column_fn.__doc__ = builder.__doc__
    return column_fn


# Above this many expressions one SQL statement (fixed cost: a temporary view
# and a parse) is cheaper than ``selectExpr`` (one driver call per expression).
WIDE_PROJECTION = 7


def select_sql(df: DataFrame, exprs: Sequence[str], where: str | None = None) -> DataFrame:
    """``SELECT exprs FROM df [WHERE where]``.  Wide projections go through
    one SQL statement over the DataFrame, narrow ones through ``selectExpr``;
    the analysed plan is the same either way."""
    if len(exprs) < WIDE_PROJECTION:
        return (df.where(where) if where else df).selectExpr(*exprs)
    body = "SELECT " + ", ".join(exprs) + " FROM __src__"
    if where:
        body += f" WHERE {where}"
    text = body.replace("{", "{{").replace("}", "}}").replace("__src__", "{src}")
    return df.sparkSession.sql(text, src=df)


def project(df: DataFrame, *exprs: str, where: str | None = None) -> DataFrame:
    """``selectExpr`` as one SQL statement; chains as ``df.transform(project, ...)``."""
    return select_sql(df, exprs, where)
