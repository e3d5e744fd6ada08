"""The corpus operators against brute force, round trips and held-out rows,
and on nulls, empty texts, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storelens.llm import (
    bpe_automaton, embed_dedup, exact_packing, lang_id, license_scan, line_dedup, minhash_dedup,
    pii_sanitise, queries, toxicity_pu, winnowing)
from storelens.llm.components import connected_components

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]
DOCS = "doc_id long, text string, id long, key string, n long"


def odd_docs(spark, rows=None):
    """Nulls, empties, a long text, repeats and columns that clash with the operators' own."""
    long = " ".join(random.Random(1).choices(WORDS, k=20000))
    rows = rows if rows is not None else [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (5, long), (None, "a b c d e f"),
        (6, "a b c d e f"), (7, "one two"), (8, "ONE two"), (9, "12 34 5 !!"), (9, "other text of nine")]
    return spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 150)] + \
        [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5)]
    df = spark.createDataFrame([*edges, (None, 3)], "x long, y long")
    got = {r[0]: r[1] for r in connected_components(df)[0].collect()}
    want = components({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k != v}


def brute_shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def check_minhash(rows, got):
    sets = {i: brute_shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(ids, links)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == \
        {i: (len(sets[i]), want[i], want[i] == i) for i in ids}


def test_minhash_brute_force(spark):
    docs = queries.documents(spark, SF, "doc_id", "text")
    check_minhash([tuple(r) for r in docs.collect()], queries.op4_minhash_dedup(spark, SF).collect())


def test_minhash_large_bucket(spark, monkeypatch):
    """Variants of one text: more members than a small bucket, several components."""
    monkeypatch.setattr(minhash_dedup, "SMALL", 4)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rng, base, rows = random.Random(5), random.Random(4).choices(WORDS, k=120), []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    check_minhash(rows, minhash_dedup.near_duplicates(odd_docs(spark, rows)).collect())


def test_minhash_odd(spark):
    got = minhash_dedup.near_duplicates(odd_docs(spark)).collect()
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 9)}
    assert len(got) == 12 and by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[5].component_id == 4 and by[8].component_id == 7 and by[6].n_shingles == 2
    assert minhash_dedup.near_duplicates(empty(spark)).collect() == []


def test_embeddings_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", "embedding").collect()]
    rows += [(9000, None), (9001, [0.0] * 64), (9002, [float("nan")] * 64), (9003, [None] * 64),
             (9004, []), (9005, [1.0, 2.0]), (9006, [2.0, 4.0]), (9007, rows[0][1]), (9008, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, id int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    good = {i: np.array(np.array(v, np.float32), np.float64) for i, v in rows
            if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.95]
    want = components([i for i, _ in rows], links)
    n = {i: sum(i in e for e in links) for i, _ in rows}
    assert got == {i: (n[i], want[i]) for i, _ in rows}
    assert embed_dedup.near_duplicates(df.limit(0)).collect() == []


def test_bpe_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(2)
    letters = list("abcdeéÉß'.,! \t\n0123<|>ΣσςЖж日🎉\x1c\xa0\x00lloo")
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(400)]
    texts += ["a<|endoftext|>b", "llllll ==== hhhhe", None, ""]
    texts += [r.text for r in queries.documents(spark, SF, "text").collect()]
    docs = odd_docs(spark, list(enumerate(texts)))
    out = bpe_automaton.decode(bpe_automaton.encode(docs, queries.tokenizer_path()),
                               queries.tokenizer_path())
    for r in out.collect():
        ids = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe_automaton.encode(empty(spark), queries.tokenizer_path()).collect() == []


def check_packing(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark):
    docs = queries.documents(spark, SF, "doc_id", "text").unionByName(
        odd_docs(spark).select("doc_id", "text"))
    rows = exact_packing.pack(exact_packing.token_pieces(docs, queries.tokenizer_path())).collect()
    n = check_packing(rows)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1
    assert len(rows) == len({(r.sequence_id, r.offset) for r in rows})
    one = next(r for r in rows if r.doc_id == 1 and r.length == 1)
    assert bytes(one.ids) == b"\0\0\0\0"
    pieces = exact_packing.token_pieces(empty(spark), queries.tokenizer_path())
    assert exact_packing.pack(pieces).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 65): rng.randrange(1, 40) for _ in range(rng.randrange(1, 40))}
    slots = exact_packing.plan(counts, 64)
    used, bins = {}, {}
    for length, _, n, first, offset in slots.tolist():
        used[length] = used.get(length, 0) + n
        for k in range(n):
            bins.setdefault(first + k, []).append((offset, length))
    assert used == counts
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64


def best_fit_decreasing(counts, capacity):
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            i = min((i for i, g in enumerate(gaps) if g >= length), key=gaps.__getitem__, default=None)
            if i is None:
                gaps.append(capacity - length)
            else:
                gaps[i] -= length
    return len(gaps)


def test_packing_hot_length():
    """One length holds many pieces: equal pieces share bins, whatever is shorter."""
    def bins(counts, capacity):
        slots = exact_packing.plan(counts, capacity)
        assert {x: int(slots[slots[:, 0] == x, 2].sum()) for x in counts} == counts
        return int((slots[:, 2] + slots[:, 3]).max())
    assert bins({1024: 1000, 10: 1}, 2048) == 501 and bins({300: 600, 10: 1}, 2048) == 100
    assert bins({1024: 3, 1000: 1, 24: 1}, 2048) == 2 and bins({700: 10**9, 3: 5}, 2048) == 5 * 10**8
    rng = random.Random(12)
    for _ in range(60):
        counts = {rng.randrange(1, 129): rng.randrange(1, 20) for _ in range(rng.randrange(1, 40))}
        counts[rng.randrange(1, 129)] = rng.randrange(100, 200)
        n, area = bins(counts, 128), sum(k * v for k, v in counts.items())
        assert -(-area // 128) <= n <= best_fit_decreasing(counts, 128)


def brute_base(text):
    out = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                           r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                           r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = re.sub(r"[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or k == 2 and 12 <= len(d) <= 19 and luhn or k == 3 and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans():
    rng = random.Random(6)
    letters = list("ab.@@@.-+ 0123456789 ()é")
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(80)))
        assert pii_sanitise.base_spans(text) == brute_base(text), text
    text = "a 4111 1111 1111 1111 b x@y.z.de +49 (30) 1234-567 10.0.0.256 1.2.3.4"
    assert pii_sanitise.base_spans(text) == brute_base(text)


def test_pii_terms_and_text(spark):
    rows = [(i, "plain words here and there") for i in range(20)]
    rows += [(100 + i, f"ask zarquon about mail me@host.org now {i}") for i in range(4)]
    docs = odd_docs(spark, rows + [(1000, None), (1001, "")])
    got = {r.doc_id: r for r in pii_sanitise.find_spans(docs).collect()}
    assert [s.kind for s in got[100].base] == ["email"] and got[1000].base == got[1001].terms == []
    text = {r.doc_id: r.text for r in pii_sanitise.sanitise(docs).collect()}
    assert "zarquon" not in text[100] and "[email]" in text[100] and text[3] == rows[3][1]
    assert text[1000] is None and pii_sanitise.sanitise(empty(spark)).collect() == []


def test_pii_terms_far_away(spark):
    """A name goes where it stands far from the address, and without it."""
    rows = [(i, "plain words here and there, one two three four five six seven") for i in range(60)]
    rows += [(100 + i, "me@host.org plain words here and there one two three four five six zarquon")
             for i in range(20)] + [(200, "here Zarquon alone and there")]
    text = {r.doc_id: r.text for r in pii_sanitise.sanitise(odd_docs(spark, rows)).collect()}
    assert text[100] == "[email] plain words here and there one two three four five six "
    assert text[200] == "here  alone and there" and text[3] == rows[3][1]


def test_line_dedup(spark):
    line = " ".join(random.Random(8).choices(WORDS, k=300)) + " today"
    near = next(x for x in (f"{line[:-5]}{w}" for w in WORDS) if bin(int(np.bitwise_xor(
        *line_dedup.simhashes([line, x]))) & (1 << 64) - 1).count("1") <= line_dedup.APART)
    docs = odd_docs(spark, [(1, f"alpha\n{line}"), (2, f"{near}\nalpha\n{line.upper()}!"), (3, None),
                            (4, ""), (5, "alpha beta gamma delta epsilon zeta"), (5, "x"), (5, "x")])
    got = line_dedup.dedup_lines(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and by[1].text == f"alpha\n{line}" and by[2].text == "alpha"
    assert by[3].text is None and by[4].text == "" and by[2].removed_lines == [0, 2]
    assert line_dedup.dedup_lines(empty(spark)).collect() == []


def test_line_dedup_short(spark):
    """Exact copies go at any number of words, also in scripts without blanks."""
    docs = odd_docs(spark, [(1, "Read more!\n这是一个没有空格的句子\nsubscribe\nok"),
                            (2, "read more\n这是一个没有空格的句子。\nSubscribe\nok\nkept line")])
    by = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert by[1].removed_lines == [] and by[2].removed_lines == [0, 1, 2]
    assert by[2].text == "ok\nkept line"


def brute_lines(rows):
    """{id: numbers of removed lines} by comparing all lines with each other."""
    where, norm = [], []
    for i, text in sorted(rows):
        for n, line in enumerate(text.split("\n")):
            where.append((i, n))
            norm.append(" ".join(re.findall(r"\w+", line.lower())))
    links = [(x, y) for x in range(len(norm)) for y in range(x) if line_dedup.similar(norm[x], norm[y])]
    group = components(range(len(norm)), links)
    out = {i: [] for i, _ in rows}
    for x, g in group.items():
        if x != g:
            out[where[x][0]].append(where[x][1])
    return out


def test_line_dedup_one_letter(spark):
    """One letter changed, in lines of 3 words and more."""
    rng, rows = random.Random(13), []
    for i in range(120):
        line = " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
                        for _ in range(rng.choice([3, 6, 12, 25, 50, 120])))
        at = rng.choice([k for k, c in enumerate(line) if c != " "])
        rows += [(2 * i, line), (2 * i + 1, f"{line[:at]}z{line[at + 1:]}")]
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(odd_docs(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == want and sum(map(len, want.values())) >= 115


@pytest.mark.parametrize("small", [2, 1000])
def test_line_dedup_shared_bucket(spark, monkeypatch, small):
    """One word is the majority: buckets for lines in several components."""
    monkeypatch.setattr(line_dedup, "GROUP", small)
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    rng, rows = random.Random(14), []
    for i in range(30):
        other = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(9)]
        line = " ".join(["de"] * 10 + other)
        rows += [(3 * i, line), (3 * i + 1, line + "x"), (3 * i + 2, line + "xyz")]
    texts = [x for _, x in rows]
    keys, _ = line_dedup.line_keys(texts, line_dedup.simhashes(texts))
    assert np.unique(keys, return_counts=True)[1].max() > 9  # a component has 3 lines
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(odd_docs(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == want and sum(map(len, want.values())) == 60


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]
    rng = random.Random(9)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain(a, b)


def test_line_profiles_keep_similar():
    """The count of grams never drops a pair within the edit distance."""
    rng = random.Random(21)
    for _ in range(200):
        a = "".join(rng.choices("abcde ", k=rng.randrange(6, 200)))
        b = list(a)
        for _ in range(int(0.1 * len(a))):
            b[rng.randrange(len(b))] = rng.choice(["", "x", "ab"])
        b = "".join(b)
        if line_dedup.similar(a, b):
            assert line_dedup.possible(line_dedup.profiles([a]), line_dedup.profiles([b]),
                                       np.array([max(len(a), len(b))]))[0]


def test_line_candidates_at_any_batch_size(monkeypatch):
    """Pairs of small buckets and members of large ones, however rows are cut."""
    rng = np.random.default_rng(4)
    key = np.sort(np.concatenate([rng.integers(0, 300, 900), np.full(200, 77)]))
    rows = sorted(zip(key.tolist(), rng.permutation(len(key)).tolist(), strict=True))
    key, name = (np.array(x) for x in zip(*rows, strict=True))
    sim = rng.choice([0, 7, -1], len(key))
    chars = np.full(len(key), 100)
    monkeypatch.setattr(line_dedup, "GROUP", 50)

    def run(step, least):
        monkeypatch.setattr(line_dedup, "ROWS", least)
        out = set()
        for batch in line_dedup._candidates(
                pa.RecordBatch.from_arrays([pa.array(x[i:i + step]) for x in (key, name, chars, sim)],
                                           names=["key", "class", "chars", "sim"])
                for i in range(0, len(key), step)):
            out |= {tuple(r.values()) for r in batch.to_pylist()}
        return out

    whole = run(len(key), 1 << 16)
    assert {r[2] for r in whole if r[1] is None} >= {77}
    for step, least in ((1, 1), (13, 1), (64, 100), (500, 60)):
        assert run(step, least) == whole


def test_line_simhash():
    lines = ["a b c d e", "one two three", "one two three four five six"]
    one = [line_dedup.simhashes([x])[0] for x in lines]
    assert line_dedup.simhashes(lines).tolist() == one


def test_language(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01", "doc_id", "text", "lang")
    got = queries.op8_lang_id(spark, "/root/testdata/sf0.01").where("held_out").join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    model = lang_id.learn(docs)
    odd = {r.doc_id: r.lang_pred for r in lang_id.with_language(odd_docs(spark), model).collect()}
    assert odd[1] == odd[2] == odd[3] == "und" and odd[7] != "und"
    none = lang_id.learn(docs.limit(0))
    assert {r.lang_pred for r in lang_id.with_language(odd_docs(spark), none).collect()} == {"und"}
    assert lang_id.with_language(empty(spark), model).collect() == []


def test_toxicity(spark):
    got = queries.op2_toxicity_pu(spark, "/root/testdata/sf0.1").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit >= 0.85 * sum(r.toxic for r in got) and hit >= 0.85 * sum(r.predicted for r in got)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity_pu.learn(odd_docs(spark), labels)
    scores = [r.score for r in toxicity_pu.score(odd_docs(spark), model).collect()]
    assert len(scores) == 12 and max(scores) < 1e-9
    assert toxicity_pu.score(empty(spark), model).collect() == []


def test_licenses(spark):
    rows = [(1, "Released under the MIT License.", "a/b/LICENSE"), (2, "code", "a/b/c/x"),
            (3, "Licensed under the Apache License, Version 2.0", "a/b/c/d/NOTICE"),
            (4, "code", "a/b/c/d/y"), (5, "code", "z/q"), (6, None, None), (7, "", "a/w")]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, path string, folder string")
    got = {r.doc_id: (r.license, r.inherited_from) for r in license_scan.scan(docs).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", "a/b"), 3: ("Apache-2.0", None),
                   4: ("Apache-2.0", "a/b/c/d"), 5: (None, None), 6: (None, None), 7: (None, None)}
    assert license_scan.scan(docs.limit(0)).collect() == []


def test_license_query_nested(spark, tmp_dir):
    """Every depth of folders can decide in the registered query."""
    texts = {10: "Released under the MIT License.", 1001: "Licensed under CC BY 4.0.",
             1102: "Licensed under the Apache License, Version 2.0"}
    rows = [(i, texts.get(i, "code"), "s") for i in (10, 12, 20, 1001, 1011, 1012, 1102, 1103, 2002)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: (r.license, r.inherited_from)
           for r in queries.op3_license_scan(spark, tmp_dir).collect()}
    assert got == {10: ("MIT", None), 12: ("MIT", "s"), 20: ("MIT", "s"), 1001: ("CC-BY-4.0", None),
                   1011: ("CC-BY-4.0", "s/1"), 1012: ("CC-BY-4.0", "s/1"), 1102: ("Apache-2.0", None),
                   1103: ("Apache-2.0", "s/1/11"), 2002: ("MIT", "s")}


def test_license_files(spark):
    """Long licence files decide for their directory; a header may be wrapped
    over lines or stand in a long line."""
    other = " ".join(random.Random(15).choices(WORDS, k=300))
    mit = ("Copyright (c) 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person\n"
           f"obtaining a copy of this software and associated documentation\nfiles, to deal {other}")
    gpl = ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + other
           + "\na work licensed under version 3 of the GNU Affero General Public License " + other)
    rows = [(1, mit, "m/LICENSE.txt"), (2, "code", "m/x"), (3, gpl, "g/COPYING"), (4, "code", "g/h/y"),
            (5, f"{other} released under the MIT License {other}", "p/q"), (6, "code", "p/r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.doc_id: (r.license, r.inherited_from, r.is_license_file)
           for r in license_scan.scan(docs).collect()}
    assert got == {1: ("MIT", None, True), 2: ("MIT", "m", False), 3: ("GPL-3.0", None, True),
                   4: ("GPL-3.0", "g", False), 5: ("MIT", None, False), 6: (None, None, False)}


def test_winnowing(spark):
    docs = queries.documents(spark, SF, "doc_id", "text").unionByName(
        spark.createDataFrame([(9000, None), (9001, ""), (9002, "one two")], "doc_id long, text string"))
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in winnowing.edited_fingerprints(docs).collect()}
    assert sorted(got) == sorted(rows)
    for i, d in enumerate(order):
        text, nxt = rows[d], rows[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert got[d].n_chars == len(text)
        assert hashlib.sha256(got[d].edited_text.encode()).digest() == hashlib.sha256(edited.encode()).digest()
    # the window rule, in plain Python over the grams' own hashes
    one = winnowing.winnow(docs.where("doc_id < 40"), "text", "f").collect()
    hashes = {r.doc_id: r.g for r in docs.where("doc_id < 40").select("doc_id", F.expr(
        "transform(filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> ''), w -> xxhash64(w))")
        .alias("h")).select("doc_id", F.expr(
            "transform(sequence(0, greatest(0, size(h) - 5)), i -> xxhash64(get(h, i), get(h, i + 1),"
            " get(h, i + 2), get(h, i + 3), get(h, i + 4)))").alias("g")).collect()}
    for r in one:
        g, want = hashes[r.doc_id], []
        for i in range(max(1, len(g) - 15)):
            p = min(range(i, min(len(g), i + 16)), key=lambda p: (g[p] & ((1 << 33) - 1), -p))
            if p not in want:
                want.append(p)
        assert r.f_positions == want and r.f_hashes == [g[p] for p in want]
    assert winnowing.edited_fingerprints(empty(spark)).collect() == []


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    rows = corpus_pipeline.run(spark, SF).collect()
    assert check_packing(rows) > 0
