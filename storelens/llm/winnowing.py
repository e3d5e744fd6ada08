"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken, 2003),
in DataFrame functions only.

Words (``[^\\x20\\x09-\\x0D]+``) are hashed, every ``K`` consecutive words make
a 64-bit gram hash, and of every window of ``W`` grams the smallest is
selected, the rightmost among equals.  Selected grams keep their positions
(word number, from 0), so two texts that share a run of at least K + W - 1
words share a selected gram.  A text of fewer than K words has one gram, of
all its words; one of fewer than W grams has one window.  The window minimum
is taken over (33 hash bits, position) packed in a long, by doubling the
window four times; each step is one pass over the text's grams.

Null and empty texts have an empty fingerprint; two empty fingerprints are
alike (1.0), an empty and another are not (0.0).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, W = 5, 16
_BITS = 30  # of a position: a string has fewer words
_LAST = (1 << _BITS) - 1


def winnow(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with ``{name}_hashes`` array<long> and ``{name}_positions``
    array<int>, in the order of the text, appended."""
    def t(x):
        return f"_{name}_{x}"

    df = df.withColumn(t("words"), F.expr(
        f"filter(split(`{text_col}`, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"))
    df = df.withColumn(t("h"), F.expr(f"transform({t('words')}, w -> xxhash64(w))")).drop(t("words"))
    parts = ", ".join(f"get({t('h')}, i + {j})" for j in range(K))
    df = df.withColumn(t("g"), F.expr(
        f"if(coalesce(size({t('h')}), 0) <= 0, cast(array() as array<bigint>),"
        f" transform(sequence(0, greatest(0, size({t('h')}) - {K})), i -> xxhash64({parts})))"
    )).drop(t("h"))
    df = df.withColumn(t("m1"), F.expr(
        f"transform({t('g')}, (g, i) -> shiftleft(g & {(1 << (63 - _BITS)) - 1}L, {_BITS})"
        f" | ({_LAST}L - i))"))
    width = 1
    while width < W:
        df = df.withColumn(t(f"m{2 * width}"), F.expr(
            f"transform({t(f'm{width}')}, (x, i) -> least(x, get({t(f'm{width}')}, i + {width})))"
        )).drop(t(f"m{width}"))
        width *= 2
    df = df.withColumn(f"{name}_positions", F.expr(
        f"transform(array_distinct(slice({t(f'm{W}')}, 1, greatest(1, size({t('g')}) - {W - 1}))),"
        f" x -> cast({_LAST}L - (x & {_LAST}L) as int))")).drop(t(f"m{W}"))
    return df.withColumn(f"{name}_hashes", F.expr(
        f"transform({name}_positions, p -> get({t('g')}, p))")).drop(t("g"))


def fingerprint_text(name: str) -> F.Column:
    """``hash:position`` of every selected gram, comma-joined."""
    return F.expr(f"array_join(zip_with({name}_hashes, {name}_positions,"
                  f" (h, p) -> concat(lower(hex(h)), ':', p)), ',')")


def likeness(a: str, b: str) -> F.Column:
    """Jaccard similarity of two fingerprints' gram sets."""
    return F.expr(
        f"case when size({a}) <= 0 and size({b}) <= 0 then 1.0D"
        f" when size({a}) <= 0 or size({b}) <= 0 then 0.0D"
        f" else size(array_intersect({a}, {b})) / cast(size(array_union({a}, {b})) as double) end")


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (bucket, last, id, text) whose order within a bucket, id and text
    descending, continues in the row marked ``last``: the next bucket's first
    document (the first of all after the last).  Buckets are ranges of ids of
    about equal size, about sqrt(n) of them, so no order over all documents is
    needed.  Null texts are empty; null ids come last."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.count()
    buckets = max(1, math.isqrt(n))
    cuts = rows.where("id IS NOT NULL").agg(F.percentile_approx(
        "id", [i / buckets for i in range(1, buckets)] or [0.5], max(10000, 4 * buckets))).first()[0]
    cuts = sorted(set(cuts or []))
    depth = max(1, len(cuts).bit_length())
    listed = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.expr(
        "cast(array() as array<bigint>)")
    # binary search: how many cuts are at most the id
    steps = [1 << s for s in range(depth - 1, -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda lo, s: lo + F.when(F.get(listed, lo + s - 1) <= F.col("id"), s).otherwise(0))
    placed = rows.withColumn("bucket", F.coalesce(found, F.lit(0)))
    heads = placed.groupBy("bucket").agg(
        F.max(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("o"), "text")).alias("head"))
    order = Window.orderBy("bucket")  # a row per bucket
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("bucket", F.coalesce(
        F.lag("head").over(order), F.last("head").over(every))["text"].alias("text"))
    return placed.select("bucket", F.lit(False).alias("last"), "id", "text").unionByName(
        heads.select("bucket", F.lit(True).alias("last"), F.lit(None).cast("long").alias("id"), "text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fingerprint, its edited text (second half
    replaced by as much of the next document, in descending order of ids) and
    that text's fingerprint, and their likenesses."""
    rows = winnow(with_next_text(docs, id_col, text_col).repartition("bucket"), "text", "own")
    order = Window.partitionBy("bucket").orderBy(
        "last", F.col("id").desc_nulls_last(), F.col("text").desc())
    rows = (rows.withColumn("next_text", F.lead("text").over(order))
            .withColumn("next_hashes", F.lead("own_hashes").over(order)).where("NOT last")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited_text", F.expr(
                "concat(substring(text, 1, cast(n_chars - n_chars div 2 as int)),"
                " substring(next_text, 1, cast(n_chars div 2 as int)))")))
    rows = winnow(rows, "edited_text", "edited")
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_text",
        fingerprint_text("own").alias("fingerprint"),
        fingerprint_text("edited").alias("edited_fingerprint"),
        likeness("own_hashes", "edited_hashes").alias("near_edited"),
        likeness("own_hashes", "next_hashes").alias("near_next"))
