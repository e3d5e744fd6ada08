"""Catalog access: listing tables and reading models by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def list_tables(spark: SparkSession, database: str | None = None) -> set[str]:
    """Names of tables and views visible in the catalog (``SHOW TABLES``)."""
    return {t.name for t in spark.catalog.listTables(database)}


def missing_tables(spark: SparkSession, required: Iterable[str],
                   database: str | None = None) -> set[str]:
    """Required names that are absent; an empty set means all are present."""
    return set(required) - list_tables(spark, database)


def require_tables(spark: SparkSession, required: Iterable[str],
                   database: str | None = None) -> None:
    """Raises with the missing names unless all required tables are there."""
    missing = missing_tables(spark, required, database)
    if missing:
        raise LookupError(f"tables missing from the warehouse: {sorted(missing)}")


def read_model(spark: SparkSession, name: str) -> DataFrame:
    """A materialised model (table or view) by name."""
    return spark.table(name)
