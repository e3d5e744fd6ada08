"""Row-level operators: dedup, ordered top-k, deterministic exact sample,
count expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.sql import ident
from storelens.functions.sql import project

# Rows generated per task-sized chunk when a count is expanded into rows.
EXPAND_CHUNK_ROWS = 1_000_000


def distinct_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """GROUP BY all listed columns with no aggregate (NULLs group together).
    Planned as partial + final hash aggregate, so duplicates collapse map-side
    before the shuffle."""
    return df.select(*columns).distinct()


def top_k(df: DataFrame, n: int, order: Sequence[Column], ties: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``order`` with ``ties`` (ascending, NULLs last) as
    a total order.  ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject:
    each task keeps its own top n, one task merges them — no global sort."""
    spec = list(order) + [F.col(t).asc_nulls_last() for t in ties]
    return df.orderBy(*spec).limit(n)


def exact_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, uniformly chosen, without replacement.

    Rows are ranked by md5 of ``seed|key...``: the choice does not depend on
    partitioning, a retried task picks the same rows, and any engine with
    md5 can reproduce the sample.  The top-n runs as a bounded
    TakeOrderedAndProject (``df.sample`` is only approximate in size).
    """
    keys = ", ".join(f"coalesce(CAST({ident(k)} AS STRING), '')" for k in key)
    rank = F.expr(f"md5(concat_ws('|', '{int(seed)}', {keys}))")
    return (df.withColumn("_sample_rank", rank)
            .orderBy(F.col("_sample_rank"), *[F.col(k).asc_nulls_last() for k in key])
            .limit(n).drop("_sample_rank"))


def expand_rows(df: DataFrame, count_col: str, chunk_rows: int = EXPAND_CHUNK_ROWS,
                partitions: int | None = None) -> DataFrame:
    """Replace each row by ``count_col`` copies of itself (rows with a count
    below 1 vanish); the count column is dropped.

    A row whose count is huge (a hot key) is first cut into chunks of at most
    ``chunk_rows`` copies and the chunk descriptors are hash-distributed over
    ``partitions`` tasks before the copies are generated, so no single task
    materialises a hot group.  Only the compact descriptors are shuffled.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        try:
            partitions = max(partitions, spark.sparkContext.defaultParallelism)
        except Exception:  # Spark Connect: no SparkContext on the client
            pass
    cols = [ident(c) for c in df.columns if c != count_col]
    n, size = f"CAST({ident(count_col)} AS BIGINT)", f"{int(chunk_rows)}L"
    chunks = (
        df.where(f"{n} >= 1")
        .transform(project, *cols, f"{n} AS _n",
                   f"explode(sequence(0L, ({n} - 1) div {size})) AS _chunk")
        .transform(project, *cols, f"least({size}, _n - _chunk * {size}) AS _chunk_rows",
                   f"xxhash64({', '.join(cols)}, _chunk) AS _spread")
        # explicit partition count: AQE does not coalesce it back into one task
        .repartition(partitions, "_spread")
    )
    copies = chunks.transform(project, *cols, "explode(sequence(1L, _chunk_rows)) AS _copy")
    return copies.transform(project, *cols)
