"""The pipeline's rows, and disclosing terms against a plain count."""

import math
import random
import re

import corpus_pipeline
import pytest
from storelens.llm import pii_sanitise
from tests.llm.test_llm import WORDS, brute_base, empty, odd_docs


def groups_of(text):
    """Entities of a text, by plain means: values, and what they belong to."""
    out = set()
    for a, k, b in brute_base(text):
        value = text[a:b].lower() if k < 2 else re.sub(r"[^0-9]", "", text[a:b])
        group = ["@" + value.split("@")[-1], re.match(r"[0-9]+(\.[0-9]+)?", value)[0] if k == 1 else "",
                 value[:6], value[:-4]][k]
        out |= {(k, "value", value), (k, "group", group)}
    return out


def plain_words(text):
    """Words that no base span touches."""
    base = brute_base(text)
    return [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", text)
            if not any(a < m.end() and m.start() < b for a, _, b in base)]


def plain_terms(rows):
    """Words to remove, from the counts of all documents, pair by pair."""
    n, gone = len(rows), set()
    words = {i: {w for w, _, _ in plain_words(t)} for i, t in rows}
    all_words = {i: set(re.findall(r"[^\W\d_]{3,}", t.lower())) for i, t in rows}
    having = {i: groups_of(t) for i, t in rows}
    for e in set().union(*having.values()):
        with_e = [i for i, _ in rows if e in having[i]]
        if len(with_e) < pii_sanitise.SUPPORT or 2 * len(with_e) > n:
            continue
        for t in set().union(*(words[i] for i in with_e)):
            both = sum(t in words[i] for i in with_e)
            n_t = sum(t in w for w in all_words.values())
            if both >= pii_sanitise.SUPPORT and math.log2(n * both / (len(with_e) * n_t)) \
                    >= pii_sanitise.DISCLOSE * math.log2(n / len(with_e)):
                gone.add(t)
    return gone


def test_pii_terms_are_those_of_a_plain_count(spark):
    """No address is in two documents; their hosts, networks, issuers and
    exchanges are, and their names go wherever they stand."""
    rng, words = random.Random(21), [f"{a}{b}a" for a in "bcdfgklmnprst" for b in ("ane", "olu", "iri")]
    rows = []
    for i in range(240):
        text = " ".join(rng.choices(words, k=12))
        if i % 20 == 0:
            text += f" zarquon p{i}x@host.org here"
        if i % 20 == 1:
            text = f"Quuxnet 10.7.{i}.9 {text}"
        if i % 24 == 2:
            text += f" +1 (212) 555-{1000 + i} frobozz {rng.choice(words)}"
        if i % 60 == 5:
            text += " zarquon alone"
        rows.append((i, text))
    want = plain_terms(rows)
    assert {"quuxnet", "frobozz"} <= want
    got = {r.doc_id: r for r in pii_sanitise.find_spans(odd_docs(spark, rows)).collect()}
    for i, text in rows:
        assert [(s.start, s.end) for s in got[i].terms] == [
            (a, b) for w, a, b in plain_words(text) if w in want], text


def test_pipeline_keeps_rows_not_ids(spark):
    """Repeated rows stay once, a unique text stays whatever id it shares."""
    rng = random.Random(22)
    x, y, z = (" ".join(rng.choices(WORDS, k=60)) for _ in range(3))
    rows = [(5, x), (9, y), (9, x + " more"), (9, y), (None, z), (None, z), (7, z), (8, "a b"), (8, "a b"),
            (8, None), (8, None), (3, "")]
    docs = odd_docs(spark, rows).selectExpr("*", "1 AS _row", "2 AS component_id")
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=key) == sorted(
        [(5, x), (9, y), (None, z), (8, "a b"), (8, None), (3, "")], key=key)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_pipeline_stages_take_odd_rows(spark, name, stage):
    docs = odd_docs(spark).selectExpr("*", "'en' AS lang", "'s' AS source", "1 AS _row", "'c' AS base")
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and out.count() <= docs.count()
    none = empty(spark).selectExpr("*", "'en' AS lang")
    assert stage(spark, none, "").collect() == []


def test_pipeline_removes_its_tables(spark, tmp_path):
    """What a run leaves is what its result still reads."""
    import os

    from storelens.llm.common import scratch_noted
    docs = odd_docs(spark).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    with scratch_noted() as paths:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got
    left = [os.path.basename(p) for p in paths if os.path.exists(p.removeprefix("file:"))]
    assert not any(p.startswith(s) for p in left for s in (
        "pipeline-language_id", "pipeline-line_dedup", "pipeline-near_dedup", "minhash", "pii", "line-")), left
