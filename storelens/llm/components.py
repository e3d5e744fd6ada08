"""Connected components of an undirected edge list, as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  Every step aggregates the
smallest neighbour per node (combined map-side), writes it, and joins it back
to the edges; both join inputs come straight from a shuffle, so a node with a
large share of all edges is split by the skew-join rule instead of landing in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import discard, written


def _star(edges: DataFrame, large: bool, paths: list[str]) -> DataFrame:
    """One step over edges (u, v) with u > v."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select("u", "v")
    least, p = written(near.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "components-min")
    paths.append(p)
    linked = near.join(least, "u")
    if large:  # every larger neighbour moves to the smallest neighbour
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node itself and its smaller neighbours move to the smallest
        out = linked.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u > v").distinct()


def connected_components(edges: DataFrame) -> tuple[DataFrame, str]:
    """Rows (node, component) for every node with an edge to another node;
    ``component`` is the smallest node reachable.  ``edges`` has two long
    columns; loops, repeats, either direction and nulls are allowed (an edge
    with a null end links nothing).  Returns the table and its scratch path.
    """
    spark = edges.sparkSession
    a, b = edges.columns[:2]
    now, now_path = written(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "components")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == mark:
            break
        mark, paths = state, []
        big, big_path = written(_star(now, True, paths), "components")
        nxt, nxt_path = written(_star(big, False, paths), "components")
        discard(spark, now_path, big_path, *paths)
        now, now_path = nxt, nxt_path
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")), now_path
