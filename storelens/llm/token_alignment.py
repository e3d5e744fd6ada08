"""Cross-tokenizer alignment by as-of joins of token starts.

A text is coded by two tokenizers whose tokens cover the same bytes, a space
and the text.  Per batch, ``pandas.merge_asof`` keyed by document finds for
every token start the covering token of the other side; both directions
together give all overlapping pairs.  Pairs that end together are *links*, and
their ends cut the text into *groups*.

``align`` gives every document's groups and its links as counted id pairs;
``with_link_counts`` adds how often those pairs are linked in the corpus.
Pairs with at least one link in ``SHARE`` are fewer than ``SHARE``, whatever
the corpus: they are broadcast, so that a pair that a third of all links hold
is never shuffled.  All rarer pairs are joined by shuffle.

Texts that are null or empty, or that one side can't spell byte by byte, have
no tokens.  Rows that repeat, with null ids or not, are listed each.  Texts are
coded whole, in slices of documents of about ``SLICE`` bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.common import discard, map_arrow, text_slices, written
from storelens.llm.wordtext import byte_letters

SLICE = 1 << 20
SHARE = 200_000

LONG_GAP = 10_000  # a run of white space that the splitter's look-ahead can't be given

# The splitter of byte-level files that ask for one, and its white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GAP = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
                  f"{{{LONG_GAP},}}")


class ByteBpe:
    """Side A: a byte-level BPE file, coded by its merges as ranks."""

    def __init__(self, raw: bytes):
        j = json.loads(raw)
        model, before = j["model"], j["pre_tokenizer"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)]
                  for m in model["merges"]]
        if model["type"] != "BPE" or j["normalizer"] is not None or before["type"] != "ByteLevel" \
                or before["add_prefix_space"] or not before["use_regex"] or merged != sorted(merged):
            raise ValueError("a byte-level BPE with its merges in the order of ids is expected")
        letter = {c: b for b, c in byte_letters().items()}
        special = {x["content"] for x in j["added_tokens"]}
        self.spelled = [b""] * (max(model["vocab"].values()) + 1)
        for entry, i in model["vocab"].items():
            if entry not in special:
                self.spelled[i] = bytes(letter[c] for c in entry)
        ranks = {s: i for i, s in enumerate(self.spelled) if s}
        self.coder, self.whole = (tiktoken.Encoding(
            "ranks", pat_str=p, special_tokens={}, mergeable_ranks=ranks) for p in (_SPLIT, r"(?s:.+)"))

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self._code(" " + t) for t in texts]

    def _code(self, text: str) -> list[int]:
        """A long gap is one word of the splitter's, but for its last character
        where a word follows."""
        if len(text) < LONG_GAP:
            return self.coder.encode_ordinary(text)
        out, at = [], 0
        for m in _GAP.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += self.coder.encode_ordinary(text[at:m.start()]) + self.whole.encode_ordinary(text[m.start():end])
            at = end
        return out + self.coder.encode_ordinary(text[at:])


class PieceBpe:
    """Side B: a sentencepiece model that puts a space before the text."""

    def __init__(self, raw: bytes):
        self.coder = p = sentencepiece.SentencePieceProcessor(model_proto=raw)
        pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.spelled = [bytes([int(s[1:-1], 16)]) if p.is_byte(i)
                        else s.replace("▁", " ").encode() for i, s in enumerate(pieces)]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


class Aligner:
    """Both sides, and the tables that a slice is aligned with."""

    def __init__(self, a_raw: bytes, b_raw: bytes):
        self.sides = ByteBpe(a_raw), PieceBpe(b_raw)
        self.sizes = [np.array([len(s) for s in x.spelled]) for x in self.sides]
        self.n = max(map(len, self.sizes))
        # every id's text, followed by each separator
        self.labels = [f"{i}{sep}" for sep in (",", "|", ";") for i in range(self.n)]

    def code(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        some = [t or "" for t in texts]
        coded = [side(some) for side in self.sides]
        for i, t in enumerate(some):
            whole = (" " + t).encode()
            if not t or any(b"".join(map(s.spelled.__getitem__, c[i])) != whole
                            for s, c in zip(self.sides, coded, strict=True)):
                coded[0][i] = coded[1][i] = []
        return coded[0], coded[1]

    def frame(self, side: int, ids: list[list[int]]) -> pd.DataFrame:
        """Tokens by place; both sides' documents have the same bytes, so
        places run on from document to document alike."""
        count = [len(x) for x in ids]
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(count))
        end = np.cumsum(self.sizes[side][flat])
        doc = np.repeat(np.arange(len(ids)), count)
        return pd.DataFrame({"doc": doc, "start": end - self.sizes[side][flat], "end": end,
                             "token": np.arange(len(flat)), "id": flat})

    def overlaps(self, a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of tokens (rows of ``a``, rows of ``b``) that share a byte."""
        def covering(x, y):
            return pd.merge_asof(
                x[["doc", "start", "token"]],
                y[["doc", "start", "token"]].assign(begin=y["start"]).rename(
                    columns={"token": "other"}), on="start", by="doc")

        ab, ba = covering(a, b), covering(b, a)
        ba = ba[ba["begin"] != ba["start"]]  # equal starts are found from both sides
        return (np.concatenate([ab["token"].to_numpy(), ba["other"].to_numpy().astype(np.int64)]),
                np.concatenate([ab["other"].to_numpy().astype(np.int64), ba["token"].to_numpy()]))

    def group_text(self, a: pd.DataFrame, b: pd.DataFrame, cuts: np.ndarray, docs: int) -> list[str]:
        """Every document's ``a1,a2|b1;a3|b2,b3``."""
        ga, gb = np.searchsorted(cuts, a["end"]), np.searchsorted(cuts, b["end"])
        in_a, in_b = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
        place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[ga]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[gb]
        label = np.empty(len(a) + len(b), np.int64)
        label[place_a] = a["id"] + self.n * np.append(np.diff(ga) > 0, True)
        label[place_b] = b["id"] + 2 * self.n * np.append(np.diff(gb) > 0, True)
        words = list(map(self.labels.__getitem__, label.tolist()))
        ends = np.cumsum(np.bincount(a["doc"], minlength=docs) + np.bincount(b["doc"], minlength=docs))
        return ["".join(words[i:j])[:-1] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def slice(self, texts: list[str | None], detail: bool) -> dict[str, pa.Array]:
        docs = len(texts)
        ids_a, ids_b = self.code(texts)
        a, b = self.frame(0, ids_a), self.frame(1, ids_b)
        pa_, pb = self.overlaps(a, b) if len(a) else (np.empty(0, np.int64),) * 2
        ends_a, ends_b = a["end"].to_numpy(), b["end"].to_numpy()
        linked = ends_a[pa_] == ends_b[pb]
        la, lb = pa_[linked], pb[linked]
        cuts = np.sort(ends_a[la])  # no two links end at one place
        doc = a["doc"].to_numpy()
        each = np.bincount(doc[la], minlength=docs)
        # equal id pairs of a document are one entry with a count
        nb = len(self.sizes[1])
        code = doc[la] * (len(self.sizes[0]) * nb) + a["id"].to_numpy()[la] * nb + b["id"].to_numpy()[lb]
        code, times = np.unique(code, return_counts=True)
        of, code = np.divmod(code, len(self.sizes[0]) * nb)
        starts = pa.array(np.searchsorted(of, np.arange(docs + 1)).astype(np.int32))
        out = {
            "n_a": pa.array(np.bincount(doc, minlength=docs)),
            "n_b": pa.array(np.bincount(b["doc"], minlength=docs)),
            "n_groups": pa.array(np.bincount(doc[np.searchsorted(ends_a, cuts)], minlength=docs)),
            "n_links": pa.array(each),
            "n_overlaps": pa.array(np.bincount(doc[pa_], minlength=docs)),
            "groups": pa.array(self.group_text(a, b, cuts, docs), pa.string()),
            "pairs": pa.ListArray.from_arrays(starts, pa.array((code // nb << 32) | code % nb)),
            "times": pa.ListArray.from_arrays(starts, pa.array(times.astype(np.int32))),
        }
        if detail:
            order = np.lexsort((pb, pa_))
            pa_, pb = pa_[order], pb[order]
            first_a = np.searchsorted(doc, np.arange(docs))
            first_b = np.searchsorted(b["doc"].to_numpy(), np.arange(docs))
            at = pa.array(np.searchsorted(doc[pa_], np.arange(docs + 1)).astype(np.int32))
            out["a_ids"] = pa.array(ids_a, pa.list_(pa.int32()))
            out["b_ids"] = pa.array(ids_b, pa.list_(pa.int32()))
            out["overlap_a"] = pa.ListArray.from_arrays(
                at, pa.array((pa_ - first_a[doc[pa_]]).astype(np.int32)))
            out["overlap_b"] = pa.ListArray.from_arrays(
                at, pa.array((pb - first_b[doc[pa_]]).astype(np.int32)))
        return out


_aligners: dict[str, Aligner] = {}


def aligner(key: str, a_raw: bytes, b_raw: bytes) -> Aligner:
    """Made once per Python worker and pair of files."""
    if key not in _aligners:
        _aligners[key] = Aligner(a_raw, b_raw)
    return _aligners[key]


def _files(spark: SparkSession, a_path: str, b_path: str):
    raw = []
    for p in (a_path, b_path):
        with open(p, "rb") as f:
            raw.append(f.read())
    return hashlib.sha256(b"".join(raw)).hexdigest(), spark.sparkContext.broadcast(raw)  # two files


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          detail: bool = False) -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_overlaps, groups, pairs, times)
    for every row of ``docs``: ``pairs`` are the distinct linked id pairs
    (``a << 32 | b``), ``times`` how often each.  With ``detail`` also both id
    lists, and the overlapping pairs as token places ``overlap_a``,
    ``overlap_b``."""
    key, files = _files(docs.sparkSession, a_path, b_path)

    def run(batches):
        one = aligner(key, *files.value)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                made = one.slice(part.column(1).to_pylist(), detail)
                yield pa.RecordBatch.from_arrays([part.column(0), *made.values()],
                                                 names=[id_col, *made])

    more = ", a_ids array<int>, b_ids array<int>, overlap_a array<int>, overlap_b array<int>"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(
        source, run, f"`{id_col}` long, n_a long, n_b long, n_groups long, n_links long,"
        " n_overlaps long, groups string, pairs array<bigint>, times array<int>"
        + (more if detail else ""))


def link_counts(links: DataFrame) -> DataFrame:
    """Rows (pair, n, best) for rows (pair, times): an id pair's links in the
    corpus, and whether no other pair of its B id has more.  The pairs of a B
    id are no more than side A's entries."""
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = links.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b", b)
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (``align``, any further columns) without ``pairs`` and
    ``times``, and with ``n_best`` (links whose pair is its B id's most linked
    one) and ``count_sum`` (sum of the counts over the links)."""
    spark = aligned.sparkSession
    others = [c for c in aligned.columns if c not in ("pairs", "times")]
    table, _ = written(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    links = table.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "_row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts, counts_path = written(link_counts(links), "link-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(counts.where(F.col("n") > total // SHARE).select("pair", "n", "best"))
    rare = counts.where(F.col("n") <= total // SHARE)

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    far = sums(links.join(often.select("pair"), "pair", "left_anti").join(rare, "pair"))
    each, each_path = written(
        sums(links.join(often, "pair")).unionAll(far).groupBy("_row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "link-sums")
    discard(spark, counts_path)
    return table.join(each, "_row", "left").select(
        *others, F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"))
