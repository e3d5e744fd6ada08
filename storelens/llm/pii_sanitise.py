"""Personal data: fixed patterns, then information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, payment cards and phone
numbers.  Each base value is a protected entity e, and so is the group it belongs
to (the host of an address, the first two bytes of an IP address, the first six
digits of a card, a phone number without its last four digits): a value is seldom
in several documents, its group often is.  All words of the documents that mention
an entity are candidate terms t; over the whole corpus the documents that
mention e (n_e), hold t (n_t) and hold both (n_et) are counted.  What t discloses
about e is their pointwise mutual information, log2(N n_et / (n_e n_t)), against
the entity's own information log2(N / n_e) (Sanchez, Batet and Viejo, 2013).  A
term whose share is at least ``DISCLOSE`` is removed wherever it stands, also in
documents that do not mention e; at least ``SUPPORT`` joint documents are asked
for, as one joint document shows nothing, and e is in half of all documents at
most.

Null and empty texts have no spans.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, text_slices, written

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT, DISCLOSE, MARKS = 3, 0.95, 1 << 20
# The patterns of the four base kinds.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, in order."""
    out = []
    at = text.find("@")
    end = 0
    while at >= 0:  # a match begins where the run of local characters before its @ does
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append((m.start(), 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entities(text: str, spans) -> list[str]:
    """The values the spans mention, each also with its last part left out: an
    address's host, a network of 16 bits, a card's issuer, a line's exchange."""
    out = set()
    for start, kind, end in spans:
        value, name = text[start:end].lower(), KINDS[kind]
        if kind == 0:
            group = value[value.index("@"):]
        elif kind == 1:
            group = ".".join(value.split(".")[:2])
        else:
            value = "".join(_DIGIT.findall(value))
            group = value[:6] if kind == 2 else value[:-4]
        out |= {f"{name}:{value}", f"{name} group:{group}"}
    return sorted(out)


def _words_outside(text: str, spans) -> list[tuple[str, int, int]]:
    """(word, start, end) of the words that no base span touches."""
    out, i, reach = [], 0, 0
    for m in _WORD.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach, i = max(reach, spans[i][2]), i + 1
        if reach <= m.start():
            out.append((m.group().lower(), m.start(), m.end()))
    return out


def _detect(batches):
    for batch in batches:
        for part in text_slices(batch, "text"):
            ids, base, entities = [], [], []
            for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                spans = base_spans(text) if text else []
                ids.append(i)
                base.append([{"start": a, "kind": KINDS[k], "end": b} for a, k, b in spans])
                entities.append(_entities(text, spans) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()),
                 pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()),
                                                    ("end", pa.int64())]))),
                 pa.array(entities, pa.list_(pa.string()))], names=["key", "base", "entities"])


def _mark(word: str) -> int:
    return zlib.crc32(word.encode()) % MARKS


def _marks(df: DataFrame, column: str) -> list[int]:
    """The marks of a column's values, ``MARKS`` numbers at most."""
    return [r[0] for r in df.select(
        (F.crc32(F.col(column).cast("binary")) % MARKS).cast("int")).distinct().collect()]


def _document_words(batches):
    """Partial counts (term, n): documents of the task that hold the word."""
    count: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
            names=["term", "n"])
        count.clear()
        return batch

    for batch in batches:
        for part in text_slices(batch, "text"):
            for text in part.column(0).to_pylist():
                if text:
                    count.update(set(_WORD.findall(text.lower())))
            if len(count) > 400_000:
                yield out()
    yield out()


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, terms): lists of (start, kind, end), in order, for
    every row of ``docs``; ``terms`` are the method's spans.  Rows that repeat
    an id and a text are counted once and listed each."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # a row's key: its id and its text, so that repeated ids stay apart
    keyed = source.select(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")),
                                      F.xxhash64("text").cast("string")).alias("key"), "text", "id")
    rows = keyed.select(F.concat_ws("#", "key", F.coalesce(F.col("id").cast("string"), F.lit("-")))
                        .alias("key"), "text")
    found, _ = written(map_arrow(
        rows, _detect, "key string, base array<struct<start bigint, kind string, end bigint>>, "
        "entities array<string>"), "pii-found")
    total = found.count()
    mentions, _ = written(found.where("size(entities) > 0").select(
        "key", F.explode("entities").alias("entity")).distinct(), "pii-mentions")
    # fewer mentions can't have SUPPORT joint documents
    by_entity, _ = written(mentions.groupBy("entity").agg(F.count("*").alias("n_e"))
                           .where(f"n_e >= {SUPPORT} AND n_e * 2 <= {total}"), "pii-entities")
    near = mentions.join(by_entity, "entity")
    holders = _marks(by_entity, "entity")

    def candidates(batches):
        """(key, term) of the documents that mention an entity of these marks."""
        have = np.zeros(MARKS, bool)
        have[holders] = True
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                keys, terms = [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                     strict=True):
                    spans = base_spans(text) if text else []
                    if spans and any(have[_mark(e)] for e in _entities(text, spans)):
                        found = {w for w, _, _ in _words_outside(text, spans)}
                        keys += [key] * len(found)
                        terms += found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(terms, pa.string())], names=["key", "term"])

    words = map_arrow(rows if holders else rows.limit(0), candidates,
                      "key string, term string").distinct()
    pairs, _ = written(
        near.join(words, "key").groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et"))
        .where(f"n_et >= {SUPPORT}"), "pii-pairs")
    # every task counts a word for itself, so the counts are summed before they meet the pairs
    by_term = map_arrow(source.select("text"), _document_words, "term string, n long") \
        .groupBy("term").agg(F.sum("n").alias("n_t"))
    flagged, _ = written(
        pairs.join(by_term, "term")
        .where(f"log2({total}D * n_et / (cast(n_e as double) * n_t))"
               f" >= {DISCLOSE} * log2({total}D / n_e)")
        .select("term").distinct(), "pii-flagged")
    # words whose mark no flagged term has stay in their task
    marks = _marks(flagged, "term")

    def places(batches):
        have = np.zeros(MARKS, bool)
        have[marks] = True
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                out = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                     strict=True):
                    if text and any(have[_mark(w)]
                                    for w in set(_WORD.findall(text.lower()))):
                        out += [(key, w, a, b) for w, a, b in _words_outside(text, base_spans(text))
                                if have[_mark(w)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                     pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64())],
                    names=["key", "term", "start", "end"])

    placed = map_arrow(rows if marks else rows.limit(0), places,
                       "key string, term string, start long, end long")
    terms = placed.join(flagged, "term", "left_semi").groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", F.lit("term").alias("kind"), "end"))).alias("terms"))
    out = found.select("key", "base").join(terms, "key", "left")
    return out.select(
        F.expr("try_cast(substring_index(key, '#', -1) as bigint)").alias(id_col), "base",
        F.coalesce("terms", F.expr("cast(array() as array<struct<start bigint, kind string, end bigint>>)"))
        .alias("terms"), F.substring_index("key", "#", 1).alias("key"))


def span_list(spans: str) -> F.Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def ordered(spans: str) -> F.Column:
    """Spans by start, then kind as listed, then end."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"transform(array_sort(transform({spans}, s -> struct(s.start as start,"
        f" array_position(array({names}), s.kind) as o, s.end as end, s.kind as kind))),"
        " s -> struct(s.start as start, s.kind as kind, s.end as end))")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with base values generalised to their kind,
    ``[email]``, and disclosing terms removed."""
    columns = docs.columns
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")),
                      F.xxhash64(F.col(text_col)).cast("string"))
    spans = find_spans(docs, id_col, text_col).where("size(base) + size(terms) > 0").select(
        F.col("key").alias("_key"), F.concat("base", "terms").alias("_spans")).dropDuplicates(["_key"])
    joined = docs.withColumn("_key", key).join(spans, "_key", "left")

    @F.arrow_udf("string")
    def clean(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            if t and s:
                parts, at = [], 0
                for x in sorted(s, key=lambda x: (x["start"], -x["end"])):
                    if x["start"] >= at:
                        parts += [t[at:x["start"]], "" if x["kind"] == "term" else f"[{x['kind']}]"]
                    at = max(at, x["end"])
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return joined.withColumn(text_col, F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(
        clean(F.col(text_col), F.col("_spans")))).select(*columns)
