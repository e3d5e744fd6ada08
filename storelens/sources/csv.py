"""CSV sources for the raw app and review files.

All columns are read as strings, by the names in each file's own header (no
inference pass over the data).  A folder may hold files of different column
order or with further columns: the files are grouped by header, every group is
read with its own schema, and the groups are united by name.

Quoted fields may hold commas, doubled quotes and, with ``multiline=True``,
line breaks.  Such files are still read in parallel.  A first scan counts the
quotes of every input split; the running count over a file's splits tells
whether a split starts inside a quoted field.  If every line of a group is a
record by itself (an even number of quotes in each), the group is read as plain
CSV.  Otherwise every task cuts its split into records, starting at the first
true boundary, and the pieces of the records that cross a split (at most two a
split) are put together by a small grouped step.  A field that holds a quote
has to be quoted itself, as the format asks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelens.functions.sql import ident
from storelens.sources.schemas import (
    APPS_COLUMNS,
    APPS_RENAME,
    CSV_NULL_TOKEN,
    REVIEWS_COLUMNS,
    all_strings,
)

#: Where a row stands in its source: file, offset of its split, place in it.
POSITION = "_position"


def _options(null_value: str | None) -> dict[str, str]:
    opts = {
        "quote": '"', "escape": '"', "mode": "PERMISSIVE",
        # keep the text as written: blanks matter for the NA-token match
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    return opts | ({"nullValue": null_value} if null_value is not None else {})


def normalize_header(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Strip blanks around column names, then apply the rename map."""
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in (rename or {}).items() if k in df.columns})


# -- header catalogue ------------------------------------------------------------

def _first_record(spark: SparkSession, file: str) -> str | None:
    """A file's header line, through the cluster's file system API; None when
    the file is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        lines: list[str] = []
        while True:
            line = reader.readLine()
            if line is None:
                break
            lines.append(line)
            if sum(x.count('"') for x in lines) % 2 == 0:
                break
        return "\n".join(lines) if lines else None
    finally:
        reader.close()


def _names(line: str) -> tuple[str, ...]:
    import csv

    return tuple(next(csv.reader([line.removeprefix("﻿")], strict=False)))


def header_catalogue(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` (a file, folder or glob) by the names of their
    header, as written.  Only every file's first line is read."""
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(16) as pool:
        first = list(pool.map(lambda f: _first_record(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, line in zip(files, first, strict=True):
        if line is not None:
            groups[_names(line)].append(file)
    return dict(groups)


# -- records that span lines -------------------------------------------------------

def _quotes(df: DataFrame) -> DataFrame:
    """Quotes per input split, whether they are odd in some line, and whether a
    carriage return stands inside a line."""
    q = F.length("value") - F.length(F.translate("value", '"', ""))
    return df.groupBy("file", "block").agg(
        (F.sum(q) % 2).alias("odd"), F.max(q % 2).alias("broken"),
        F.max(F.col("value").rlike("\r(?!$)").cast("int")).alias("cr"))


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(files)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), "value"))


def _cut_records(inside: dict[tuple[str, int], bool]):
    """Splits of lines -> rows (file, block, record, part, text): whole records
    (part 0), the end of a record that an earlier split began (part 1), and a
    record that this split does not end (part 2).  ``inside`` tells of every
    split whether it starts inside a quoted field."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, number, open_ = None, [], 0, False

        def piece(part: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([number], pa.int64()),
                 pa.array([part], pa.int32()), pa.array(["\n".join(held)], pa.string())],
                names=["file", "block", "record", "part", "text"])

        for batch in batches:
            blocks = batch.column(1).to_numpy()
            files = batch.column(0)
            change = np.flatnonzero(np.diff(blocks) != 0) + 1
            if pc.count_distinct(files).as_py() > 1:
                names = files.to_pylist()
                change = np.unique([*change, *(i for i in range(1, len(names)) if names[i] != names[i - 1])])
            for start, end in zip([0, *change], [*change, len(blocks)], strict=True):
                start, end = int(start), int(end)
                if start == end:
                    continue
                here = files[start].as_py(), int(blocks[start])
                if here != at:
                    if held:
                        yield piece(2 if not open_ else 1)
                    if here not in inside:
                        raise RuntimeError("the input splits changed between two scans; run again")
                    # open_: still inside the record that an earlier split began
                    at, held, number, open_ = here, [], 0, inside[here]
                text = batch.column(2).slice(start, end - start)
                odd = pc.count_substring(text, '"').to_numpy(zero_copy_only=False) % 2
                inside_before = bool(held) or open_
                # the record a line belongs to: a new one starts after a line
                # that leaves no quoted field open
                state = (np.cumsum(odd) + inside_before) % 2  # after each line
                ends = np.flatnonzero(state == 0)
                lines = text.to_pylist()
                pos = 0
                if inside_before:
                    if not len(ends):
                        held += lines
                        continue
                    held += lines[:ends[0] + 1]
                    if open_:
                        yield piece(1)
                    else:
                        yield piece(0)
                        number += 1
                    held, open_, pos = [], False, int(ends[0]) + 1
                rest = ends[ends >= pos]
                if len(rest):
                    begins = np.concatenate([[pos], rest[:-1] + 1])
                    out = [lines[b] if b == e else "\n".join(lines[b:e + 1])
                           for b, e in zip(begins.tolist(), rest.tolist(), strict=True)]
                    n = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at[0]] * n), pa.array(np.full(n, at[1], np.int64)),
                         pa.array(np.arange(number, number + n)), pa.array(np.zeros(n, np.int32)),
                         pa.array(out, pa.string())],
                        names=["file", "block", "record", "part", "text"])
                    number += n
                    pos = int(rest[-1]) + 1
                held = lines[pos:]
        if held:
            yield piece(2 if not open_ else 1)
    return run


def _records(spark: SparkSession, files: list[str], splits: list) -> DataFrame:
    """Rows (file, block, record, text), one per CSV record, headers left out."""
    inside: dict[tuple[str, int], bool] = {}
    count: dict[str, int] = defaultdict(int)
    for r in sorted(splits, key=lambda r: (r["file"], r["block"])):
        inside[r["file"], r["block"]] = bool(count[r["file"]] % 2)
        count[r["file"]] += r["odd"]
    cut = _lines(spark, files).mapInArrow(
        _cut_records(inside), "file string, block long, record long, part int, text string")
    whole = cut.where("part = 0").select("file", "block", "record", "text")
    # a record's pieces: one that a split leaves open, then what later splits add
    by_file = Window.partitionBy("file").orderBy("block", "part", "record")
    pieces = cut.where("part > 0").withColumn(
        "begun", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(by_file))
    joined = (pieces.groupBy("file", "begun")
              .agg(F.array_sort(F.collect_list(F.struct("block", "part", "record", "text"))).alias("p"))
              .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["record"].alias("record"),
                      F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text")))
    return (whole.unionByName(joined)
            .withColumn("text", F.regexp_replace("text", "\r$", ""))
            .where("text <> '' AND NOT (block = 0 AND record = 0)"))


# -- readers ------------------------------------------------------------------------

def _plain(spark: SparkSession, files: list[str], n: int, null_value: str | None, position: bool) -> DataFrame:
    df = (spark.read.schema(all_strings([f"c{i}" for i in range(n)])).option("header", True)
          .options(**_options(null_value)).csv(files))
    place = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("record"))
    return df.select("*", place.alias(POSITION)) if position else df


def _spanning(spark: SparkSession, files: list[str], n: int, null_value: str | None, position: bool) -> DataFrame:
    splits = _quotes(_lines(spark, files)).collect()  # one row per input split
    if not any(r["broken"] or r["cr"] for r in splits):
        return _plain(spark, files, n, null_value, position)
    columns = [f"c{i}" for i in range(n)]
    parsed = F.from_csv("text", F.lit(", ".join(f"{c} string" for c in columns)),
                        _options(null_value) | {"multiLine": "true"})
    df = _records(spark, files, splits).select(
        parsed.alias("r"), F.struct("file", "block", "record").alias(POSITION))
    return df.select("r.*", *([POSITION] if position else []))


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] | list[str],
             rename: dict[str, str] | None = None, multiline: bool = False, missing: str = "error",
             null_value: str | None = None, position: bool = False) -> DataFrame:
    """CSV files united by header name, all text.

    Header names are stripped of blanks and renamed; of a name that a header
    holds twice the first column counts.  A file without a required column is
    an error that names it, or with ``missing="null"`` has NULLs there.  Other
    columns are kept, NULL in files without them.  ``position`` appends
    ``POSITION``, struct<file, block, record>, which orders the rows as the
    files hold them.  No file, or only empty ones: no rows."""
    if missing not in ("error", "null"):
        raise ValueError("missing must be 'error' or 'null'")
    groups = header_catalogue(spark, path)
    out: DataFrame | None = None
    for header, files in groups.items():
        names = [(rename or {}).get(c.strip(), c.strip()) for c in header]
        absent = [c for c in required if c not in names]
        if absent and missing == "error":
            raise ValueError(f"{files[0]}: columns missing from the header: {absent}")
        read = _spanning if multiline else _plain
        df = read(spark, files, len(names), null_value, position)
        keep = [F.col(f"c{names.index(c)}").alias(c) for c in dict.fromkeys(names) if c]
        df = df.select(*keep, *([POSITION] if position else []))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], all_strings(required))
        if position:
            out = out.withColumn(POSITION, F.expr(
                "cast(NULL AS struct<file: string, block: bigint, record: bigint>)"))
    out = out.withColumns({c: F.lit(None).cast("string") for c in required if c not in out.columns})
    others = [c for c in out.columns if c not in required]
    return out.select(*map(ident, [*required, *others]))


def read_apps_csv(spark: SparkSession, path: str, multiline: bool = False, missing: str = "error",
                  position: bool = False) -> DataFrame:
    """Raw app listings, header names trimmed and renamed, all text."""
    return read_csv(spark, path, APPS_COLUMNS, APPS_RENAME, multiline, missing, position=position)


def read_reviews_csv(spark: SparkSession, path: str, multiline: bool = False, missing: str = "error",
                     position: bool = False) -> DataFrame:
    """Raw user reviews, all text."""
    return read_csv(spark, path, REVIEWS_COLUMNS, None, multiline, missing, position=position)


def read_seed_csv(spark: SparkSession, path: str, columns, multiline: bool = True) -> DataFrame:
    """A CSV written by ``sinks.export_csv``: missing values are the NULL token."""
    return read_csv(spark, path, tuple(columns), None, multiline, null_value=CSV_NULL_TOKEN).select(
        *map(ident, columns))
