"""Sinks: landing tables, CSV export, model materialisation.

Only this package and ``plans.pipeline`` write; every dataset function is a
pure DataFrame -> DataFrame plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.sinks.versions import current_path, read_current, refresh
from storelens.sources.schemas import CSV_NULL_TOKEN


def _is_path(target: str) -> bool:
    return "/" in target or "://" in target


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to an explicit target schema (the landing DDL)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def land_table(df: DataFrame, target: str, schema: T.StructType | None = None,
               fmt: str = "parquet", observation: Observation | None = None,
               options: dict[str, str] | None = None, versioned: bool = False) -> DataFrame:
    """Full-refresh landing: the target is replaced by exactly ``df``'s rows
    (an empty frame leaves an empty table, never the old rows).  ``target``
    is a path or a catalog table name.  Returns a fresh read of the target,
    so later plans start from the written files, not the lineage.

    With an ``observation``, the written row count is collected during the
    write itself (``observation.get["rows"]``) — no second pass over the data.

    With ``versioned`` a path target is replaced safely (``sinks.versions``): a
    write that fails leaves the old table as it was, and readers resolve it by
    ``read_current``.

    ``fmt``/``options`` select any Spark data source, e.g. ``fmt="jdbc"`` with
    ``{"url": ..., "dbtable": ...}`` to land in a relational store (then
    ``target`` is only a label and the same options read the table back).
    """
    if schema is not None:
        df = conform(df, schema)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    spark = df.sparkSession
    if options and ("dbtable" in options or "collection" in options):
        w.save()
        return spark.read.format(fmt).options(**options).load()
    if _is_path(target):
        if versioned:
            if options:
                raise ValueError("a versioned table takes no writer options")
            return spark.read.format(fmt).schema(df.schema).load(refresh(df, target, fmt))
        w.save(target)
        # the written schema is known: no inference pass over the new files
        return spark.read.format(fmt).schema(df.schema).load(target)
    w.saveAsTable(target)
    return spark.table(target)


def _csv_writer(df: DataFrame):
    return (df.write.mode("overwrite")
            .option("header", True)
            .option("nullValue", CSV_NULL_TOKEN)
            .option("quote", '"')
            .option("escape", '"')
            # keep the text as it is: keys and joins are made from it
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False))


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               header_when_empty: bool = True) -> int:
    """CSV with a header row, missing values written as the NULL token;
    returns the number of rows written.  Many part files by default;
    ``single_file`` gathers into one task (only for small exports).

    Rows are counted while they are written (no pre-check pass).  When
    nothing was written and ``header_when_empty``, the folder is replaced by
    a single header-only file, planned from an empty relation."""
    obs = Observation("csv_export")
    out = df.coalesce(1) if single_file else df
    _csv_writer(out.observe(obs, F.count(F.lit(1)).alias("rows"))).csv(path)
    rows = int(obs.get["rows"])
    if rows == 0 and header_when_empty:
        _csv_writer(df.limit(0).coalesce(1)).csv(path)
    return rows


def materialize(df: DataFrame, name: str, materialized: str = "table",
                path: str | None = None, fmt: str = "parquet", versioned: bool = False) -> DataFrame:
    """Materialise a model: ``"table"`` writes it (to ``path`` when given, there
    as a safe refresh if ``versioned``, else as catalog table ``name``) and returns a read of the result;
    ``"view"`` registers a temporary view over the plan."""
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if materialized != "table":
        raise ValueError(f"materialized must be 'table' or 'view', not {materialized!r}")
    return land_table(df, path or name, fmt=fmt, versioned=versioned)


__all__ = ["conform", "current_path", "export_csv", "land_table", "materialize", "read_current", "refresh"]
