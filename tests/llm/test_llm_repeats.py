"""Ids that repeat with other content, clashing column names, very long digit
runs, and decoding in the encoding pass."""

import random

import numpy as np

from storelens.llm import bpe_automaton, embed_dedup, exact_packing, minhash_dedup, pii_sanitise, queries
from tests.llm.test_llm import SF, WORDS, brute_shingles, components, odd_docs


def by_row(items, linked):
    """Components of rows, named by the smallest id of their rows."""
    n = range(len(items))
    root = components(n, [(a, b) for a in n for b in n if a < b and linked(a, b)])
    least = {}
    for i in n:
        least[root[i]] = min(least.get(root[i], items[i][0]), items[i][0])
    return [least[root[i]] for i in n]


def test_minhash_repeated_ids(spark):
    """Each row is judged by its own text: y is unlike x and stays."""
    rng = random.Random(9)
    x, y = (" ".join(rng.choices(WORDS, k=60)) for _ in range(2))
    rows = [(5, x), (9, y), (9, x + " more"), (9, y), (3, y + " more"), (9, "z " * 30), (11, "z " * 31), (11, x)]
    sets = [brute_shingles(t) for _, t in rows]
    want = by_row(rows, lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    got = minhash_dedup.near_duplicates(odd_docs(spark, rows).coalesce(1)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(
        (i, len(s), c, c == i) for (i, _), s, c in zip(rows, sets, want))


def test_embeddings_repeated_ids(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(3, 1500))
    rows = [(3, base[0]), (3, base[1]), (7, base[0] + 0.01), (8, base[1] + 0.01), (7, base[2]), (1, base[2]),
            (7, base[0])]
    unit = [v / np.linalg.norm(v) for _, v in rows]
    linked = lambda a, b: unit[a] @ unit[b] >= 0.95
    want = by_row(rows, linked)
    n = [sum(linked(a, b) for b in range(len(rows)) if a != b) for a in range(len(rows))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = embed_dedup.near_duplicates(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(
        (i, k, c) for (i, _), k, c in zip(rows, n, want))


def test_pack_clashing_names(spark):
    df = spark.createDataFrame([(i % 50 + 1, i, 1, 2, 3, 4, "x") for i in range(300)],
                               "length long, offset int, _rank int, _salt int, sequence_id int, `a b` int, c0 string")
    got = exact_packing.pack(df, 64)
    assert got.columns == ["length", "_rank", "_salt", "a b", "c0", "sequence_id", "offset"]
    used = {}
    for r in got.collect():
        assert (r["_rank"], r["_salt"], r["a b"], r.c0) == (1, 2, 4, "x")
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(map(len, used.values())) == 300
    for parts in used.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= 64


def test_long_digit_runs():
    assert pii_sanitise.base_spans("1.2.3." + "0" * 5000) == [(0, 1, 5006)]
    assert pii_sanitise.base_spans("1.2.3." + "9" * 5000) == []
    assert pii_sanitise.base_spans("0" * 6000 + "255.2.3.4 x") == [(0, 1, 6009)]
    assert pii_sanitise.base_spans("000.0.0.256") == []


def test_decoding_in_the_encoding_pass(spark):
    docs = queries.documents(spark, SF, "doc_id", "text").unionByName(odd_docs(spark).select("doc_id", "text"))
    path = queries.tokenizer_path()
    one = bpe_automaton.encode(docs, path, decoded_col="decoded").collect()
    two = bpe_automaton.decode(bpe_automaton.encode(docs, path), path).collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == docs.count()
