"""Full refresh that can fail safely: versioned folders and a pointer.

A table is a folder of version folders and a small file, ``_current``, that
names the one that counts.  A refresh writes a new version beside the old one
and replaces the pointer last, by an atomic rename.  A write that dies half-way
leaves the pointer, and so the old table, as they were; what it has written is
removed by a later refresh.  The version before the current one is kept for
readers that have resolved it already.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from storelens.session import remove_path

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version folder's name that the pointer holds; None without one."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    reader = spark._jvm.java.io.BufferedReader(
        spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def current_path(spark: SparkSession, root: str) -> str:
    """The folder to read: the current version, or ``root`` itself for a table
    written without versions."""
    version = current_version(spark, root)
    return root if version is None else f"{root.rstrip('/')}/{version}"


def _commit(spark: SparkSession, root: str, version: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft, fs = _fs(spark, f"{root}/{POINTER}-{uuid.uuid4().hex[:12]}")
    out = fs.create(draft, True)
    out.write(bytearray(f"{version}\n", "utf-8"))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    context.rename(draft, target, overwrite)


def _number(version: str | None) -> int:
    return int(version[1:9]) if version else 0


def refresh(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Replaces the table at ``root`` by ``df``'s rows and returns the new
    version's folder."""
    spark, root = df.sparkSession, root.rstrip("/")
    before = current_version(spark, root)
    number = _number(before) + 1
    version = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).mode("errorifexists").save(f"{root}/{version}")
    _commit(spark, root, version)
    p, fs = _fs(spark, root)
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        # this number or a later one may belong to a refresh that is being written
        if name[:1] == "v" and name[1:9].isdigit() and name != before and _number(name) < number:
            remove_path(spark, f"{root}/{name}")
    return f"{root}/{version}"


def read_current(spark: SparkSession, root: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """The table's current version."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(current_path(spark, root))
