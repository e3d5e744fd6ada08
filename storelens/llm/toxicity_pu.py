"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Positives are confirmed toxic texts, everything else is unlabelled.  With the
class prior p, the risk of a scorer g is

    p R+(g) + max(0, Ru-(g) - p Rp-(g)),

where the bracket estimates the negatives' risk; when it turns negative on the
unlabelled sample, the step ascends it instead of fitting noise.  Features are
the presence of hashed words; those that separate positives from unlabelled
texts by at least ``DEVIATIONS`` standard errors are used, so that a long text
isn't judged by the mass of its rare words.  How many texts of either kind hold a
feature is counted over all training rows; only the gradient steps run on a
bounded sample: at most ``POSITIVES`` and ``UNLABELLED`` texts, those with the
smallest hash of their id, of which the driver gets the used features alone.  The
prior is the share of toxic rows among all labelled training rows.

Null and empty texts are scored by the intercept alone.  Without positives or
unlabelled texts, every score is the prior (0 without labels).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, text_slices, word_hashes

SPACE, POSITIVES, UNLABELLED, MARKS = 1 << 18, 4000, 12000, 1 << 20
DEVIATIONS, MOST_FEATURES = 5.0, 1024
STEPS, RATE, PENALTY = 400, 0.05, 1e-3
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def word_features(column: pa.Array) -> list[np.ndarray]:
    """Distinct hashed words of every row."""
    words, counts = word_hashes(column, _BETWEEN)
    words = (words % np.uint64(SPACE)).astype(np.int32)
    ends = np.cumsum(counts)
    return [np.unique(words[e - c:e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def _holders(batches):
    """(feature, n): rows of the task that hold the feature; feature ``SPACE``
    counts all rows."""
    count = np.zeros(SPACE + 1, np.int64)
    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            count[:SPACE] += np.bincount(np.concatenate(word_features(part.column(0))), minlength=SPACE)
            count[SPACE] += part.num_rows
    some = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])],
                                     names=["feature", "n"])


def holders(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many rows of a text column hold each of the ``SPACE`` features, and
    how many rows there are: ``SPACE`` + 1 sums come to the driver."""
    sums = map_arrow(texts, _holders, "feature int, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).toArrow()
    count = np.zeros(SPACE + 1, np.int64)
    count[sums["feature"].to_numpy()] = sums["n"].to_numpy()
    return count[:SPACE], int(count[SPACE])


def choose(held_p: np.ndarray, n_p: int, held_u: np.ndarray, n_u: int) -> np.ndarray:
    """Features that separate the two kinds, in order."""
    if not n_p or not n_u:
        return np.empty(0, np.int64)
    both = (held_p + held_u) / (n_p + n_u)
    z = np.abs(held_p / n_p - held_u / n_u) / np.sqrt(
        np.maximum(both * (1 - both), 1e-9) * (1 / n_p + 1 / n_u))
    chosen = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    return np.sort(chosen[z[chosen] >= DEVIATIONS])


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.table = np.zeros(SPACE)
        self.table[features] = weights
        self.bias = bias

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        g = np.array([self.table[r].sum() for r in rows]) + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -500, 500)))


def risk(xp: np.ndarray, xu: np.ndarray, w: np.ndarray, bias: float, prior: float
         ) -> tuple[float, np.ndarray, np.ndarray]:
    """The negatives' risk as estimated, its gradient, and the gradient of the
    positives' risk (of the weights, the bias last)."""
    # single precision throughout: mixed products would copy the matrices
    short = w.astype(np.float32)
    gp, gu = (xp @ short).astype(np.float64) + bias, (xu @ short).astype(np.float64) + bias
    sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    back_p, back_u = (sp.astype(np.float32) @ xp).astype(np.float64), \
        (su.astype(np.float32) @ xu).astype(np.float64)
    grad_neg = np.append(back_u / len(xu) - prior * back_p / len(xp), su.mean() - prior * sp.mean())
    held = xp.sum(axis=0, dtype=np.float64)
    grad_pos = prior * np.append((back_p - held) / len(xp), -(1 - sp).mean())
    return negative, grad_neg, grad_pos


def fit(xp: np.ndarray, xu: np.ndarray, chosen: np.ndarray, prior: float) -> Model:
    """From the samples' rows, 1 where a row holds the chosen feature."""
    prior = min(max(prior, 0.0), 1.0)
    if not len(xp) or not len(xu) or not 0 < prior < 1:
        return Model(np.empty(0, np.int64), np.empty(0),
                     float(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12))))
    w, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, STEPS + 1):
        negative, grad_neg, grad_pos = risk(xp, xu, w, bias, prior)
        grad = grad_pos + grad_neg if negative >= 0 else -grad_neg
        grad[:-1] += PENALTY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return Model(chosen, w, float(bias))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """From ``docs`` (training rows only) and ``labels``; an id labelled more
    than once is toxic if any of its rows says so."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marks = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("y"))
             .where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y")))
    known = marks.join(text.select("id").distinct(), "id", "left_semi")
    prior = known.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0] or 0.0
    toxic = marks.where("y = 1").select("id")
    # only texts whose id shares a mark with a toxic one are shuffled; there are
    # ``MARKS`` marks at most to broadcast
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS)).alias("mark")
    likely = text.select("*", mark).join(F.broadcast(toxic.select(mark).distinct()), "mark", "left_semi")
    held_p, n_p = holders(likely.join(toxic, "id", "left_semi").select("text"))
    held, n = holders(text.select("text"))
    chosen = choose(held_p, n_p, held - held_p, n - n_p)

    def features(batches):
        """The positions of the chosen features that a row holds."""
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                rows = [np.flatnonzero(np.isin(chosen, r, assume_unique=True)).astype(np.int32)
                        for r in word_features(part.column(1))]
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends),
                                                              pa.array(np.concatenate(rows)))],
                    names=["positive", "features"])

    # ids are picked first; they alone are shuffled, and both samples are bounded
    ids, order = text.select("id").distinct(), (F.xxhash64("id"), F.col("id"))
    picked = (ids.join(toxic, "id", "left_semi").orderBy(*order).limit(POSITIVES)
              .withColumn("positive", F.lit(True))
              .union(ids.join(toxic, "id", "left_anti").orderBy(*order).limit(UNLABELLED)
                     .withColumn("positive", F.lit(False))))
    picked = text.join(F.broadcast(picked), "id").select("positive", "text")
    rows = map_arrow(picked, features, "positive boolean, features array<int>").toArrow()
    lists = rows["features"].combine_chunks()
    x = np.zeros((len(lists), len(chosen)), np.float32)
    x[np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = 1
    positive = rows["positive"].to_numpy()
    return fit(x[positive], x[~positive], chosen, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SPACE weights

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shared.value.score(word_features(part.column(1))))],
                    names=[id_col, "score"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(source, run, f"`{id_col}` long, score double")
