"""Counts over all training rows, and the risk's gradient in both branches."""

import random
import re

import numpy as np
import pyarrow as pa
from storelens.llm import toxicity_pu
from tests.llm.test_llm import WORDS, odd_docs


def test_holders_are_a_plain_count(spark):
    rng = random.Random(31)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 30))) for _ in range(200)] + [None, "", "w1 W1, w1!"]
    count, n = toxicity_pu.holders(odd_docs(spark, list(enumerate(texts))).select("text").repartition(5))
    assert n == len(texts)
    words = {w: sum(w in set(re.findall(r"[0-9a-z]+", (t or "").lower())) for t in texts) for w in WORDS}
    place = {w: int(toxicity_pu.word_features(pa.array([w]))[0][0]) for w in words}
    for w, p in place.items():
        assert count[p] == sum(words[x] for x in words if place[x] == p) or len(
            [x for x in words if place[x] == p]) > 1
    assert count.sum() <= sum(words.values())


def test_words_rare_in_the_sample_have_weight(spark, monkeypatch):
    """Rates come from all rows: a word outside the gradient's sample counts."""
    monkeypatch.setattr(toxicity_pu, "POSITIVES", 50)
    rng = random.Random(32)
    rows = [(i, " ".join(rng.choices(WORDS, k=8)) + (f" {rng.choice(['foul', 'vile'])}" if i < 400 else ""))
            for i in range(4000)]
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(0, 4000)], "doc_id long, toxic int")
    docs = odd_docs(spark, rows)
    model = toxicity_pu.learn(docs, labels)
    got = {r.doc_id: r.score for r in toxicity_pu.score(docs, model).collect()}
    assert min(got[i] for i in range(400)) > max(got[i] for i in range(400, 4000))


def test_risk_gradients():
    """Both parts against differences; the bracket is negative for a scorer that
    calls every positive toxic and little else."""
    rng = np.random.default_rng(33)
    xp, xu = (rng.integers(0, 2, (n, 3)).astype(np.float32) for n in (40, 90))
    w, bias, prior = np.array([1.5, -0.5, 0.25]), 0.1, 0.4

    def parts(z):
        w, b = z[:-1], z[-1]
        gp, gu = xp @ w + b, xu @ w + b
        return (np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean(),
                prior * np.logaddexp(0, -gp).mean())
    z = np.append(w, bias)
    negative, grad_neg, grad_pos = toxicity_pu.risk(xp, xu, w, bias, prior)
    assert np.isclose(negative, parts(z)[0], atol=1e-6)
    for i, e in enumerate(np.eye(4) * 1e-4):
        up, down = parts(z + e), parts(z - e)
        assert np.isclose(grad_neg[i], (up[0] - down[0]) / 2e-4, atol=1e-5)
        assert np.isclose(grad_pos[i], (up[1] - down[1]) / 2e-4, atol=1e-5)
    far = np.array([[1, 0, 0]] * 40, np.float32)
    assert toxicity_pu.risk(far, np.zeros((90, 3), np.float32), np.array([9.0, 0, 0]), -5.0, prior)[0] < 0
