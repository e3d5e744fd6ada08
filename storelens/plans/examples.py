"""The two starter models of the warehouse project (M19): inline literal rows
combined with UNION ALL, and an equality filter on them.  Fixed two-row input,
so they are library functions with unit tests, not registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def example_union(spark: SparkSession) -> DataFrame:
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def example_filtered(df: DataFrame) -> DataFrame:
    """``id = 1``: NULL ids are rejected, as in SQL."""
    return df.where(F.col("id") == 1)
