"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Every vector is scaled to unit length and quantised to int8 with its own step
s: u = s q + e.  The product of two quantised vectors is exact (int8 products
summed in float32 stay below 2^24 up to 1,040 dimensions, and in float64
beyond), and |u.v - s t q.r| <= |e| + |f| + |e||f| because |u| = |v| = 1 up to
rounding.  Only pairs whose bound reaches the threshold are computed in double
precision from the vectors themselves.

Equal vectors are one class with a count; classes are dealt into about
``TILE`` rows by a hash, and every pair of tiles is one group.  A group
returns a count of links per class and a spanning forest of the links, never
the pairs.  Vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths don't link.
Repeated ids are rows of their own that share a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, ship, written
from storelens.llm.components import connected_components

THRESHOLD, TILE = 0.95, 2048
SLACK = 1e-6  # rounding of the float sums, far above their error


def packed(a: np.ndarray) -> bytes:
    """The components' bytes: single precision where that holds them exactly,
    else double; equal vectors have equal bytes (-0.0 is 0.0)."""
    with np.errstate(over="ignore"):
        short = a.astype(np.float32)
    return ((short if (short == a).all() else a) + 0).tobytes()


def unpacked(rows: list[bytes], d: int) -> np.ndarray:
    """Unit vectors in double precision of ``packed`` vectors of length ``d``."""
    out = np.empty((len(rows), d))
    for kind in (np.float32, np.float64):
        size = d * np.dtype(kind).itemsize
        at = [i for i, x in enumerate(rows) if len(x) == size]
        out[at] = np.frombuffer(b"".join(rows[i] for i in at), kind).reshape(len(at), d)
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out


def _quantise(batches):
    for batch in batches:
        size, good = [], []
        scale, err, code = [], [], []
        for x in batch.column("vector"):
            v = x.as_py()
            ok = bool(v) and None not in v
            if ok:
                a = given = np.array(v, np.float64)
                top = np.abs(a).max()
                ok = bool(np.isfinite(top) and top > 0)
            if not ok:
                for y, z in ((size, 0), (good, None), (scale, 0.0), (err, 0.0), (code, None)):
                    y.append(z)
                continue
            a = a / top  # no overflow or underflow in the norm
            u = a / np.sqrt(a @ a)
            s = np.abs(u).max() / 127
            q = np.rint(u / s).astype(np.int8)
            size.append(len(a))
            good.append(packed(given))
            scale.append(s)
            err.append(float(np.sqrt(((u - s * q) ** 2).sum())))
            code.append(q.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int32()), pa.array(good, pa.binary()),
             pa.array(scale, pa.float64()), pa.array(err, pa.float64()), pa.array(code, pa.binary())],
            names=["id", "size", "exact", "scale", "err", "code"])


def _tile_links(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        n = t.num_rows
        ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
        d = t["size"][0].as_py()
        kind = np.float32 if d <= 1040 else np.float64
        code = np.frombuffer(b"".join(t["code"].to_pylist()), np.int8).reshape(n, d).astype(kind)
        exact = unpacked(t["exact"].to_pylist(), d)
        scale, err = t["scale"].to_numpy(), t["err"].to_numpy()
        own = t["mine"].to_numpy() == t["i"][0].as_py()
        one, two = np.flatnonzero(own), np.flatnonzero(~own)
        same = not len(two) and t["i"][0].as_py() == t["j"][0].as_py()
        if same:
            two = one
        count, edges, parent = np.zeros(n, np.int64), [], list(range(n))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for k in range(0, len(one), 256):
            rows = one[k:k + 256]
            about = (code[rows] @ code[two].T) * scale[rows][:, None] * scale[two][None]
            bound = err[rows][:, None] + err[two][None] + err[rows][:, None] * err[two][None]
            x, y = np.nonzero(about + bound >= threshold - SLACK)
            x, y = rows[x], two[y]
            if same:
                x, y = x[x < y], y[x < y]
            for c in range(0, len(x), 1 << 15):
                a, b = x[c:c + (1 << 15)], y[c:c + (1 << 15)]
                link = np.einsum("ij,ij->i", exact[a], exact[b]) >= threshold
                a, b = a[link], b[link]
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
                for p, q in zip(a.tolist(), b.tolist(), strict=True):
                    p, q = root(p), root(q)
                    if p != q:
                        parent[p] = q
                        edges.append((p, q))
        some = np.flatnonzero(count)
        return pa.table({
            "a": pa.array([*ids[some].tolist(), *(int(ids[p]) for p, _ in edges)], pa.int64()),
            "b": pa.array([*[None] * len(some), *(int(ids[q]) for _, q in edges)], pa.int64()),
            "links": pa.array([*count[some].tolist(), *[0] * len(edges)], pa.int64())})
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Rows (id, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    rows, _ = written(map_arrow(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")),
        _quantise, "id long, size int, exact binary, scale double, err double, code binary"),
        "embed-rows")
    classes, _ = written(
        rows.where("exact IS NOT NULL AND id IS NOT NULL").groupBy("size", "exact")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"),
             F.first("scale").alias("scale"), F.first("err").alias("err"),
             F.first("code").alias("code"))
        # an id may repeat with other vectors: classes have numbers of their own
        .withColumn("id", F.monotonically_increasing_id()), "embed-classes")
    total = classes.count()
    tiles = max(1, -(-total // TILE))
    grid = (classes.withColumn("mine", F.pmod(F.xxhash64("exact"), F.lit(tiles)))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
            .withColumn("i", F.least("mine", F.col("other").cast("long")))
            .withColumn("j", F.greatest("mine", F.col("other").cast("long"))).drop("other"))
    ship(spark)
    # a tile pair's number, so that groups fall evenly on the shuffle's tasks
    found, _ = written(grid.groupBy("size", "i", "j").applyInArrow(
        _tile_links(threshold), "a long, b long, links long"), "embed-links")
    comp, _ = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    grouped, _ = written(
        classes.join(links, classes["id"] == links["a"], "left")
        .join(comp, F.col("id") == F.col("node"), "left")
        .select("size", "exact", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                "least", F.coalesce("component", "id").alias("group")), "embed-groups")
    names, _ = written(grouped.join(grouped.groupBy("group").agg(F.min("least").alias("component")), "group")
                       .select("size", "exact", "n_links", "component"), "embed-names")
    component = F.coalesce("component", "id")
    return rows.select("id", "size", "exact").join(names, ["size", "exact"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
