"""MinHash near-duplicates: one-permutation hashing with optimal
densification, banded buckets and star-shaped candidate edges.

1. A document's set is its distinct 5-word shingles (64-bit hashes).  Equal
   sets are one *class*, represented by its smallest id: copies are never
   expanded into pairs.
2. One permutation, 256 bins: the hash's top bits name the bin, the smallest
   hash in a bin is its value.  Empty bins copy a non-empty bin chosen by a
   hash sequence that depends on the bin only (Shrivastava, "Optimal
   Densification for Fast and Accurate Minwise Hashing", 2017).  Bins 0-127
   give 32 bands of 4 (a pair at similarity 0.75 shares no band with
   probability (1 - 0.75^4)^32 = 5e-6); the low bits of all bins are a
   256-bit sketch.
3. Star step: every bucket links its members to one centre; the links are
   confirmed on the full sets and merged into components.
4. Exact step for what a star cannot see: in buckets that still hold two or
   more components, members of *different* components meet.  In small buckets
   a join makes pairs whose set sizes and sketches allow 0.75 (six standard
   deviations), confirmed on the full sets; larger buckets are compared block
   by block on the full sets, and only links leave a block.  There is no cap on
   a bucket or on a document's partners.

Null texts, empty texts and texts without words have an empty set and link
with nothing.  A row with a null id keeps a null component, ``kept`` true,
unless an equal set names one.  Rows that repeat an id are judged each by its
own text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import discard, map_arrow, mix64, ship, text_slices, word_hashes, written
from storelens.llm.components import connected_components

WORDS, BINS, BAND_BINS, ROWS = 5, 256, 128, 4
THRESHOLD = 75  # percent
SMALL, BLOCK = 32, 256  # members of a bucket compared by a join; in a block otherwise
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct ``WORDS``-word shingle hashes of every row."""
    words, counts = word_hashes(column)
    n = max(0, len(words) - WORDS + 1)
    grams = words[:n] * _ODD[0]
    for j in range(1, WORDS):
        grams += words[j:j + n] * _ODD[j]
    grams = mix64(grams)
    out, at = [], 0
    for c in counts.tolist():
        if c >= WORDS:
            out.append(np.unique(grams[at:at + c - WORDS + 1]))
        elif c:  # the whole sequence, told apart from longer ones by its length
            out.append(mix64(mix64(words[at:at + c] * _ODD[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            out.append(words[:0])
        at += c
    return out


@lru_cache(maxsize=64)
def _probe(block: int) -> np.ndarray:
    """64 attempts x BINS: the bin that each empty bin tries."""
    at = np.arange(64, dtype=np.uint64)[:, None] + np.uint64(64 * block)
    with np.errstate(over="ignore"):
        return (mix64(np.arange(BINS, dtype=np.uint64)[None] * _ODD[0] + mix64(at + _ODD[1]))
                % np.uint64(BINS)).astype(np.int32)


def one_permutation(shingles: np.ndarray) -> tuple[np.ndarray, int]:
    """Densified bin values of a non-empty sorted set, and the number of bins
    that were filled."""
    shift = np.uint64(64 - BINS.bit_length() + 1)
    bins = (shingles >> shift).astype(np.int32)  # sorted, as the set is
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    value, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    value[bins[first]], full[bins[first]] = shingles[first], True
    if len(first) == 1:
        value[:] = shingles[0]
        return value, 1
    todo, block = np.flatnonzero(~full), 0
    while len(todo):
        tries = _probe(block)[:, todo]
        hit = full[tries]
        found = hit.any(axis=0)
        pick = tries[hit.argmax(axis=0), np.arange(len(todo))]
        value[todo[found]] = value[pick[found]]
        todo, block = todo[~found], block + 1
    return value, len(first)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty sets: band keys, sketch (4 longs) and the most sketch bits
    that may differ at similarity 0.75."""
    done = [one_permutation(s) for s in sets]
    value = np.array([v for v, _ in done], np.uint64).reshape(-1, BINS)
    v = value[:, :BAND_BINS].reshape(len(value), BAND_BINS // ROWS, ROWS)
    key = np.broadcast_to(np.arange(v.shape[1], dtype=np.uint64) * _ODD[2], v.shape[:2])
    for j in range(ROWS):
        key = mix64(key * _ODD[3] + v[:, :, j])
    sketch = np.packbits((mix64(value) & np.uint64(1)).astype(np.uint8), axis=1)
    p = (1 - THRESHOLD / 100) / 2
    sd = np.sqrt(p * (1 - p) / np.maximum(1.0, np.array([f for _, f in done]) / 2))
    return (key.view(np.int64), sketch.view(np.int64),
            np.ceil(BINS * np.minimum(1.0, p + 6 * sd)).astype(np.int32))


def _lists(rows: np.ndarray, filled: np.ndarray) -> pa.Array:
    """A list column: the next row of ``rows`` where ``filled``, else null."""
    ends = np.concatenate([[0], np.cumsum(filled) * rows.shape[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()), mask=pa.array(~filled))


def _sign(batches):
    import xxhash

    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            sets = shingle_sets(part.column(1))
            size = np.array([len(s) for s in sets], np.int64)
            filled = size > 0
            bands, sketch, few = signatures([s for s in sets if len(s)])
            slack = np.zeros(len(sets), np.int32)
            slack[filled] = few
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size),
                 pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets],
                          pa.binary()),
                 _lists(bands, filled), _lists(sketch, filled), pa.array(slack)],
                names=["id", "n_shingles", "class_key", "bands", "sketch", "slack"])


def _sets(batches):
    """Of rows (class number, text, class key) those whose text has the key."""
    import xxhash

    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            sets = shingle_sets(part.column(1))
            mine = [i for i, (s, key) in enumerate(zip(sets, part.column(2).to_pylist(), strict=True))
                    if xxhash.xxh128_digest(s.tobytes()) == key]
            if not mine:
                continue
            sets = [sets[i].view(np.int64) for i in mine]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(mine)), pa.array(np.diff(ends).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
                names=["id", "n", "shingles"])


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold.  Both joins are plain
    shuffle joins on written tables, so a centre with many members is split."""
    one = pairs.join(sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"),
                                 F.col("shingles").alias("s_b")), "b")
    both = one.join(sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"),
                                F.col("shingles").alias("s_a")), "a")
    common = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return (both.select("a", "b", "n_a", "n_b", common.alias("x"))
            .where(f"100 * x >= {THRESHOLD} * (n_a + n_b - x)").select("a", "b"))


def _small_buckets(members: DataFrame) -> DataFrame:
    """Candidate pairs across components: at most ``SMALL`` / 2 per row."""
    def side(s):
        return members.select("key", *[F.col(c).alias(f"{c}_{s}") for c in
                                       ("id", "n_shingles", "slack", "component")],
                              *[F.col("sketch")[i].alias(f"s{i}_{s}") for i in range(4)])

    apart = " + ".join(f"bit_count(s{i}_a ^ s{i}_b)" for i in range(4))
    return side("a").join(side("b"), "key").where(
        f"id_a < id_b AND component_a <> component_b"
        f" AND 100 * least(n_shingles_a, n_shingles_b)"
        f" >= {THRESHOLD} * greatest(n_shingles_a, n_shingles_b)"
        f" AND {apart} <= greatest(slack_a, slack_b)"
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _large_buckets(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components in buckets of any size.  A bucket is dealt into
    blocks of about ``BLOCK`` members by a hash of their ids, every pair of
    blocks is one group with the members' full sets, and a group returns a
    spanning forest of the links it finds: no pair is emitted that is not a
    link, and no group grows with the bucket."""
    rows = (members.select("key", "id", "component", F.ceil(F.col("members") / BLOCK).alias("nb"))
            .withColumn("mine", F.pmod(F.xxhash64("id"), F.col("nb")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
            .select("key", "id", "component", "mine", F.least("mine", "other").alias("i"),
                    F.greatest("mine", "other").alias("j")))
    ship(sets.sparkSession)
    return (rows.join(sets.select("id", "shingles"), "id")
            .groupBy("key", "i", "j").applyInArrow(_block_links, "a long, b long"))


def _block_links(table: pa.Table) -> pa.Table:
    ids, comp = table["id"].to_numpy(), table["component"].to_numpy()
    found_a, found_b = [], []
    if len(set(comp.tolist())) > 1:
        lists = table["shingles"].combine_chunks()
        flat, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets)
        size = np.diff(ends)
        row = np.repeat(np.arange(len(ids)), size)
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]])
        column = np.cumsum(new) - 1
        shared = np.bincount(column) > 1  # only these add to an intersection
        keep = shared[column]
        row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
        side = np.array(table["mine"].to_numpy() == table["i"][0].as_py())
        one = np.flatnonzero(side)  # block i; its other block, or itself if i = j
        two = np.flatnonzero(~side) if not side.all() else one
        common = np.zeros((len(one), len(two)), np.float32)
        columns = int(column[-1]) + 1 if len(column) else 0
        step = max(1, min(columns, (4 << 20) // len(ids)))
        for c in range(0, columns, step):
            lo, hi = np.searchsorted(column, [c, c + step])
            dense = np.zeros((len(ids), step), np.float32)
            dense[row[lo:hi], column[lo:hi] - c] = 1
            common += dense[one] @ dense[two].T
        union = size[one][:, None] + size[two][None] - common
        link = (100 * common >= THRESHOLD * union) & (comp[one][:, None] != comp[two][None])
        parent = {c: c for c in set(comp.tolist())}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for x, y in zip(*np.nonzero(link), strict=True):
            x, y = one[x], two[y]
            p, q = root(int(comp[x])), root(int(comp[y]))
            if p != q:
                parent[p] = q
                found_a.append(int(ids[x]))
                found_b.append(int(ids[y]))
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id
    reachable over links), kept (the id is its component's)."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed, signed_path = written(map_arrow(base, _sign, (
        "id long, n_shingles long, class_key binary, bands array<long>, sketch array<long>, "
        "slack int")), "minhash-signed")

    # equal sets: one class, represented by its smallest id; that id may be
    # another class's too (it repeats with other text), so a class has a number
    usable = signed.where("class_key IS NOT NULL AND id IS NOT NULL")
    rep, rep_path = written(usable.groupBy("class_key").agg(
        F.min("id").alias("rep")).withColumn("class", F.monotonically_increasing_id()), "minhash-classes")
    # signatures are a function of the set: any member's row is the class's
    classes = (usable.join(rep.select("class_key", F.col("rep").alias("id"), "class"), ["class_key", "id"])
               .dropDuplicates(["class_key"]))
    # a class is in many buckets: its sketch is kept once and met where a bucket stays open
    heads, head_path = written(classes.select(F.col("class").alias("id"), "n_shingles", "sketch", "slack"),
                               "minhash-heads")
    buckets, bucket_path = written(classes.select(
        F.col("class").alias("id"), F.explode("bands").alias("key")), "minhash-buckets")

    # star step
    centres, centre_path = written(
        buckets.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z"))
        .where("a < z").select("key", "a"), "minhash-centres")
    joined = buckets.select("key", F.col("id").alias("b")).join(centres, "key").where("a < b")
    stars, star_path = written(joined.select("a", "b").distinct(), "minhash-stars")

    # full sets, made again for the documents that have a candidate or may get one
    shared = buckets.select("key", F.col("id").alias("class")).join(
        centres.select("key"), "key", "left_semi").select("class").distinct().join(rep, "class").select(
        F.col("rep").alias("id"), "class", "class_key")
    sets, set_path = written(
        map_arrow(base.join(shared, "id").select("class", "text", "class_key"), _sets,
                  "id long, n long, shingles array<long>"), "minhash-sets")
    links, link_path = written(_confirm(stars, sets), "minhash-links")
    comp, comp_path = connected_components(links)

    # exact step: members of different components in one bucket
    state, state_path = written(
        buckets.join(centres.select("key"), "key", "left_semi")
        .join(comp.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id")), "minhash-members")
    open_keys, open_path = written(
        state.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                 F.count("*").alias("members"))
        .where("lo < hi").select("key", "members"), "minhash-open")
    left, left_path = written(state.join(open_keys, "key"), "minhash-open-members")
    more, more_path = written(
        _small_buckets(left.where(f"members <= {SMALL}").join(heads, "id")), "minhash-rest")
    extra, extra_path = written(
        _confirm(more.join(stars, ["a", "b"], "left_anti"), sets)
        .union(_large_buckets(left.where(f"members > {SMALL}"), sets)), "minhash-links")
    final, final_path = connected_components(
        extra.union(comp.select("node", "component")))
    discard(spark, head_path, bucket_path, centre_path, star_path, set_path, link_path, state_path, open_path,
            left_path, more_path, extra_path, comp_path)

    grouped, _ = written(rep.join(final, rep["class"] == final["node"], "left").select(
        "class_key", "rep", F.coalesce("component", "class").alias("group")), "minhash-groups")
    names, _ = written(grouped.join(grouped.groupBy("group").agg(F.min("rep").alias("component")), "group")
                       .select("class_key", "component"), "minhash-names")
    discard(spark, rep_path, final_path)
    out = signed.select("id", "n_shingles", "class_key").join(names, "class_key", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
