"""Raw app / review inputs projected from the driver's TPC-H-style tables.

The projection is a fixed mapping (see FIXTURES.md §4): ``part`` rows become
app listings and ``lineitem`` rows become reviews of the part's app.  It
deliberately produces NULL tokens, malformed numbers, both date styles,
duplicate names and names equal to genres.  One SQL projection per table;
Catalyst prunes ``part``/``lineitem`` to the columns a query uses.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from storelens.functions.sql import select_sql
from storelens.sources.csv import POSITION

# Fixed mapping (FIXTURES.md §4), one SQL expression per raw column.
APPS_FROM_PART = (
    "p_name || ' ' || p_brand AS App",
    "CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_type END AS Category",
    "CASE WHEN p_partkey % 10 = 0 THEN 'NaN' "
    "ELSE CAST(1 + (p_partkey % 41) / CAST(10 AS DOUBLE) AS STRING) END AS Rating",
    "CAST(p_partkey * 7 % 1000 AS STRING) AS Reviews",
    "CASE WHEN p_partkey % 4 = 0 THEN 'Varies with device' "
    "WHEN p_partkey % 4 = 1 THEN CAST(p_size AS STRING) || 'M' "
    "WHEN p_partkey % 4 = 2 THEN CAST(p_size AS STRING) || '.5k' "
    "ELSE CAST(p_size AS STRING) || 'G' END AS Size",
    "CASE WHEN p_partkey % 13 = 0 THEN 'Free' ELSE CAST(p_size AS STRING) || ',000+' END AS Installs",
    "CASE WHEN p_partkey % 3 = 0 THEN 'Free' ELSE 'Paid' END AS Type",
    "CASE WHEN p_partkey % 3 = 0 THEN '0' WHEN p_partkey % 17 = 0 THEN 'Everyone' "
    "ELSE '$' || CAST(p_retailprice AS STRING) END AS Price",
    "CASE WHEN p_size < 10 THEN 'Everyone' WHEN p_size < 30 THEN 'Teen' ELSE NULL END AS Content_Rating",
    "CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' || p_brand ELSE p_brand END AS Genres",
    "CASE WHEN p_partkey % 7 = 0 THEN NULL "
    "WHEN p_partkey % 2 = 0 THEN '2018-01-' || CAST(10 + p_size % 20 AS STRING) "
    "ELSE 'January 7, 2018' END AS Last_Updated",
    "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size % 5 AS STRING) || '.0' END AS Current_Ver",
    "CAST(4 + p_size % 3 AS STRING) || '.1 and up' AS Android_Ver",
)

REVIEWS_FROM_LINEITEM = (
    "p_name || ' ' || p_brand AS App",
    "CASE WHEN l_linenumber = 7 THEN NULL "
    "ELSE 'review ' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END "
    "AS Translated_Review",
    "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'Positive' "
    "WHEN l_returnflag = 'N' THEN 'Neutral' ELSE 'Negative' END AS Sentiment",
    "CASE WHEN l_linenumber = 5 THEN 'NULL' ELSE CAST(l_discount * 20 - 1 AS STRING) END "
    "AS Sentiment_Polarity",
    "CASE WHEN l_linenumber = 5 THEN 'nan' ELSE CAST(l_tax * 10 AS STRING) END "
    "AS Sentiment_Subjectivity",
)


_SCHEMAS: dict[tuple[str, int, int], T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The schema inferred on the first read of a file
    version is reused, so later reads skip the footer-reading job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        st = os.stat(path)
        key = (os.path.abspath(path), st.st_mtime_ns, st.st_size)
    except OSError:  # not a local path: let Spark infer
        return spark.read.parquet(path)
    schema = _SCHEMAS.get(key)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[key] = df.schema
    return df


def raw_apps_from_part(part: DataFrame, position: bool = False) -> DataFrame:
    """``position`` (``part`` read from Parquet) appends where a row stands."""
    if position:
        part = part.selectExpr("*", "struct(_metadata.file_path AS file, 0L AS block,"
                               f" _metadata.row_index AS record) AS {POSITION}")
    return select_sql(part, [*APPS_FROM_PART, *([POSITION] if position else [])])


def raw_reviews_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
                         "l_discount", "l_tax")
    p = part.select("p_partkey", "p_name", "p_brand")
    # Inner equi-join on the part key; AQE picks broadcast or sort-merge from
    # the measured size of ``part`` and splits skewed partitions at run time.
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return select_sql(j, REVIEWS_FROM_LINEITEM)


def raw_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_apps_from_part(read_table(spark, sf_dir, "part"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_reviews_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                     read_table(spark, sf_dir, "part"))
