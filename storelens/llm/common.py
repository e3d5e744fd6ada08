"""Helpers shared by the corpus operators: written intermediate tables, the
documents reader, and slices of Arrow batches by text size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import remove_path, scratch_path

SLICE_BYTES = 4 << 20


_noted: list[list[str]] = []


@contextmanager
def scratch_noted() -> Iterator[list[str]]:
    """The paths of all tables ``written`` inside the block, for a caller that
    knows when the last of them has been read."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.pop()


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """What an execution inside the block has shuffled is removed from the
    executors' disks when it ends: its result is a table by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared checkpoint folder and read
    again: cuts the lineage, survives lost executors, and is one committed
    version of the rows however often a task was tried."""
    path = scratch_path(df.sparkSession, name)
    for paths in _noted:
        paths.append(path)
    with _shuffle_files_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes intermediate tables that no later step reads."""
    for p in paths:
        remove_path(spark, p)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application
    (``addPyFile``), so that tasks can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="storelens-py-")), "storelens.zip")
    with zipfile.ZipFile(target, "w") as z:
        package = os.path.dirname(here)
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("storelens", os.path.relpath(full, package)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped first."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def fold_of(col: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
                ) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with about ``limit`` bytes of text
    each (one row at least), so that a task's memory does not follow the
    number of rows in a batch."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(size.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    start = 0
    for end in [*cuts.tolist(), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]  # A-Z hash as a-z
BLOCK_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER, _BACK = _powers(_BASE, BLOCK_BYTES + 1), _powers(_INVERSE, BLOCK_BYTES + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each row starts and the
    last one ends (a null row is empty)."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], (at - at[0]).astype(np.int64)


def word_hashes(column: pa.Array, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z as a-z) of
    every row, one after the other, and the number of words of each row.
    ``between`` marks the bytes that separate words.

    A word's hash is a polynomial of its bytes, taken from running sums, so
    that no word becomes a Python object.  Rows are worked on in blocks cut
    between words; a single word longer than a block is hashed by itself.
    """
    raw, at = text_bytes(column)
    space = between[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    edge = at[:-1][(at[:-1] < at[1:])]
    begins[edge] = ~space[edge]
    ends = ~space
    ends[:-1] &= space[1:]
    edge = at[1:][(at[:-1] < at[1:])] - 1
    ends[edge] = ~space[edge]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        base = start[i]
        j = int(np.searchsorted(stop, base + BLOCK_BYTES, side="right"))
        if j == i:  # one very long word
            total, j = np.uint64(stop[i] - base), i + 1
            for k in range(base, stop[i], BLOCK_BYTES):
                part = raw[k:min(k + BLOCK_BYTES, stop[i])]
                total = mix64((_VALUE[part] * _POWER[:len(part)]).sum(keepdims=True) + total)[0]
            out[i] = total
        else:
            part = raw[base:stop[j - 1]]
            run = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_VALUE[part] * _POWER[:len(part)], out=run[1:])
            a, b = start[i:j] - base, stop[i:j] - base
            out[i:j] = mix64((run[b] - run[a]) * _BACK[a])
        i = j
    counts = np.searchsorted(start, at[1:]) - np.searchsorted(start, at[:-1])
    return out, counts
