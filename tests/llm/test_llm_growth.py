"""What is written and joined on the way does not follow the square of a group."""

import random

import numpy as np
import pytest
from storelens.llm import line_dedup, minhash_dedup, pii_sanitise
from tests.llm.test_llm import brute_lines, check_minhash, odd_docs


@pytest.fixture()
def tables(monkeypatch):
    """{name: (columns, rows, plan)} of the tables that an operator writes."""
    seen = {}

    def note(module):
        plain = module.written

        def written(df, name):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            table, path = plain(df, name)
            seen.setdefault(name, (df.columns, table.count(), plan))
            return table, path
        monkeypatch.setattr(module, "written", written)
        return seen
    return note


def test_line_pairs_of_one_template_stay_in_their_block(spark, tables):
    """Lines that share over half their text, and few that are similar."""
    seen = tables(line_dedup)
    rng, rows = random.Random(31), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    template = "".join(rng.choices(letters, k=100))
    for i in range(100):
        own = "".join(rng.choices(letters, k=50))
        rows.append((i, f"{template}{own}"))
        if i % 10 == 0:
            rows.append((1000 + i, f"{template[:40]}{template[42:]}{own}"))
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(odd_docs(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == want and sum(map(len, want.values())) == 10
    assert seen["line-rest"][1] < 400  # 203; 3,965 before blocks compared counts of grams


def test_line_short_profiles_keep_similar():
    """Counts of one byte drop no pair within the edit distance."""
    rng, kept = random.Random(32), 0
    for _ in range(300):
        a = "".join(rng.choices(rng.choice(["ab", "abcdefgh "]), k=rng.choice([6, 12, 60, 400, 3000])))
        b = list(a)
        for _ in range(int(0.09 * len(a))):
            b[rng.randrange(len(b))] = rng.choice(["", "x", "ab"])
        b = "".join(b)
        if line_dedup.similar(a, b):
            one, two = line_dedup.short_profiles([a, b])
            assert line_dedup.shortly_possible(one, two, np.array([max(len(a), len(b))]))[0]
            kept += 1
    assert kept > 50


def test_line_links_of_open_buckets_join(spark, monkeypatch, tables):
    """Tiles give links that join, not the pairs of a bucket, and join every similar line."""
    monkeypatch.setattr(line_dedup, "GROUP", 8)
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    seen = tables(line_dedup)
    rng, rows = random.Random(34), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    template = "".join(rng.choices(letters, k=90))
    for i in range(12):
        own = "".join(rng.choices(letters, k=20))
        rows += [(100 * i + k, f"{template}{own}{x}") for k, x in enumerate(["", "z", "zy", "zyx"])]
        rows.append((100 * i + 50, template + own[:13] + "".join(rng.choices(letters, k=7))))
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(odd_docs(spark, rows)).collect()}
    assert got == brute_lines(rows) and sum(map(len, got.values())) >= 36
    assert seen["line-rest"][1] < len(rows)  # 1,543 before texts were compared in the tiles


def test_line_shuffles_go_through_in_passes(spark, monkeypatch):
    """What is shuffled goes in shares, rows wait for no UDF, and every line is compared."""
    monkeypatch.setattr(line_dedup, "GROUP", 8)
    monkeypatch.setattr(line_dedup, "PASSES", 20)
    monkeypatch.setattr(line_dedup, "PASS_BYTES", 8000)
    plain, names, plans = line_dedup.written, [], []

    def written(df, name):
        names.append(name)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)
    monkeypatch.setattr(line_dedup, "written", written)
    rng, rows = random.Random(36), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    template = "".join(rng.choices(letters, k=90))
    for i in range(12):
        own = "".join(rng.choices(letters, k=20))
        rows += [(10 * i + k, f"{template}{own}{x}\nplain line {own}") for k, x in enumerate(["", "z", "zy"])]
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(odd_docs(spark, rows)).collect()}
    assert got == brute_lines(rows) and sum(map(len, got.values())) >= 48
    for name in ("line-classes", "line-found", "line-links", "line-partners"):
        assert names.count(name) > 1, name
    assert not any("ArrowEvalPython" in p for p in plans)


def test_line_pairs_at_once_equal_one_by_one(monkeypatch):
    """Edit similarity of many pairs by bit vectors of one word and of several."""
    monkeypatch.setattr(line_dedup, "FEW", 1)
    rng, lines = random.Random(35), ["", "", "abcdef", "abcdef"]
    for _ in range(400):
        letters = rng.choice(["ab", "abcde ", "abcdefghijklmnop ", "éàü日本"])
        a = rng.choices(letters, k=rng.choice([6, 12, 60, 200, 639, 640, 700, 1300]))
        b = list(a)
        for _ in range(int(rng.choice([0.02, 0.08, 0.1, 0.12]) * len(a))):
            b[rng.randrange(len(b))] = rng.choice(["", "x", letters[:2], letters[0]])
        cut = rng.choice([0, 0, rng.randrange(len(a) // 6)])
        lines += ["".join(a), "".join(b[cut:] + b[:cut] if rng.random() < 0.5 else b[cut:])]
    i, j = np.arange(0, len(lines), 2), np.arange(1, len(lines), 2)
    want = [line_dedup.similar(x, y) for x, y in zip(lines[::2], lines[1::2], strict=True)]
    assert line_dedup.similar_pairs(lines, i, j).tolist() == want
    assert line_dedup.similar_pairs(lines, j, i).tolist() == want and 100 < sum(want) < 350
    assert set(np.flatnonzero(want)) <= set(line_dedup.possible_pairs(lines, i, j).tolist())


def test_minhash_bucket_rows_hold_names_only(spark, tables):
    """A class stands in 32 buckets, its sketch in one table."""
    seen = tables(minhash_dedup)
    rng, rows = random.Random(33), []
    words = [f"w{i}" for i in range(500)]
    for i in range(20):
        text = rng.choices(words, k=60)
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:55] + rng.choices(words, k=2)))]
    check_minhash(rows, minhash_dedup.near_duplicates(odd_docs(spark, rows)).collect())
    assert seen["minhash-buckets"][0] == ["id", "key"]
    assert "sketch" not in seen["minhash-members"][0] and seen["minhash-heads"][1] == 40


def test_pii_word_counts_are_summed_before_the_join(spark, tables):
    """Each task has its own count of a word: they meet the pairs as one row."""
    seen = tables(pii_sanitise)
    rows = [(i, "plain words here and there") for i in range(20)]
    rows += [(100 + i, f"ask zarquon about mail me@host.org now {i}") for i in range(4)]
    got = {r.doc_id: r for r in pii_sanitise.find_spans(odd_docs(spark, rows).repartition(6)).collect()}
    assert len(got[100].terms) > 0 and got[3].terms == []
    assert "LeftSemi" not in seen["pii-flagged"][2]
