"""Language identification with bit-sliced Bloom filters of n-grams.

An n-gram is 2 or 3 consecutive code points of a lower-cased text with every
non-letter as a blank; a blank may stand at its ends only.  Counts of n-grams
by language cover all training texts.  A language's n-grams are those that
make up at least ``SHARE`` of its n-grams and that it uses at least ``LEAD``
as often as the language that uses them most, so mislabelled texts add
nothing; both bound the filter's size whatever the corpus.  The filter is one
table of bit masks, a bit per language: inserting sets the language's bit at
an n-gram's ``HASHES`` places, and the AND of a gram's places is the mask of
all languages that hold it.  A language's hits among a text's n-grams are
corrected for its rate f of false positives, (hits - n f) / (1 - f); the
largest decides, and the score is its share of the text's n-grams.  N-grams
are numpy codes of whole slices of texts, never Python strings.

Null texts and texts without a letter are ``und`` with score 0, as are all if
no language could be learned; ties go to the first language by name.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, mix64, ship, text_slices, written

SHARE, LEAD = 2e-5, 0.25
HASHES, BITS_PER_GRAM = 3, 16
UND = "und"
_letter: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _letter:  # once per worker
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of the texts, and the number of each one's text."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"),
                         np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    row = np.concatenate([[0], row])
    is_letter = _letters()[code.astype(np.int64)]
    code = np.where(is_letter, code, np.uint64(32))
    two = np.flatnonzero(is_letter[:-1] | is_letter[1:])
    three = np.flatnonzero(is_letter[1:-1])
    pair = (code[two] << np.uint64(21)) | code[two + 1]
    triple = ((code[three] << np.uint64(42)) | (code[three + 1] << np.uint64(21)) | code[three + 2])
    # a gram belongs to the text of its (first) letter
    return (np.concatenate([pair, triple | np.uint64(1 << 63)]),
            np.concatenate([row[np.where(is_letter[two], two, two + 1)], row[three + 1]]))


def _count_grams(batches):
    """Partial counts (lang, gram, n) of a task."""
    for batch in batches:
        for part in text_slices(batch, "text", 2 << 20):
            langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang in sorted(set(langs)):
                found, _ = grams([t for x, t in zip(langs, texts, strict=True) if x == lang])
                gram, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                     pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


class Filter:
    """The bit-sliced filter: ``table[place]`` is a mask of languages."""

    def __init__(self, rows: list[tuple[str, int]], languages: list[str]):
        self.languages = languages
        most = max(Counter(x for x, _ in rows).values(), default=1)
        self.size = 1 << max(10, (most * BITS_PER_GRAM - 1).bit_length())
        width = -(-max(1, len(languages)) // 64)
        self.table = np.zeros((width, self.size), np.uint64)
        number = {x: i for i, x in enumerate(languages)}
        if rows:
            who = np.array([number[x] for x, _ in rows])
            for at in self.places(np.array([g for _, g in rows], np.int64).view(np.uint64)):
                np.bitwise_or.at(self.table, (who // 64, at),
                                 np.uint64(1) << (who % 64).astype(np.uint64))
        fill = np.array([self._bit(self.table, k).mean() for k in range(len(languages))])
        self.false = np.minimum(fill ** HASHES, 0.99)

    def places(self, gram: np.ndarray):
        h = mix64(gram)
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            yield ((h + np.uint64(k) * step) & np.uint64(self.size - 1)).astype(np.int64)

    @staticmethod
    def _bit(masks: np.ndarray, k: int) -> np.ndarray:
        return (masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)

    def hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hits (texts x languages) and the number of n-grams of every text."""
        gram, row = grams(texts)
        mask = None
        for at in self.places(gram):
            mask = self.table[:, at] if mask is None else mask & self.table[:, at]
        count = np.bincount(row, minlength=len(texts))
        return np.array([np.bincount(row, self._bit(mask, k), len(texts))
                         for k in range(len(self.languages))]).T, count

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not texts or not self.languages:
            return [UND] * len(texts), [0.0] * len(texts)
        hits, count = self.hits(texts)
        right = np.maximum(0, hits - count[:, None] * self.false) / (1 - self.false)
        best = right.argmax(axis=1)
        score = np.minimum(1.0, right[np.arange(len(texts)), best] / np.maximum(count, 1))
        return ([self.languages[b] if n else UND for b, n in zip(best, count, strict=True)],
                score.tolist())


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filter:
    """The filter from all rows with a text and a language."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    counts, _ = written(map_arrow(rows, _count_grams, "lang string, gram long, n long")
                        .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-counts")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(total, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("p"))
    share = share.where(f"p >= {SHARE}")  # at most 1 / SHARE n-grams of a language
    top = share.groupBy("gram").agg(F.max("p").alias("top"))
    kept = share.join(top, "gram").where(f"p >= {LEAD} * top").select("lang", "gram")
    rows = sorted((r["lang"], r["gram"]) for r in kept.collect())  # the model
    return Filter(rows, sorted({x for x, _ in rows}))


def with_language(docs: DataFrame, model: Filter, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with lang_pred and score, appended."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict_texts(column: pa.Array) -> pa.Array:
        langs, scores = [], []
        for part in text_slices(pa.RecordBatch.from_arrays([column], names=["text"]), "text", 1 << 20):
            lang, score = shared.value.predict(part.column(0).to_pylist())
            langs += lang
            scores += score
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("_language", predict_texts(F.col(text_col))).select(
        *columns, "_language.lang_pred", "_language.score")
