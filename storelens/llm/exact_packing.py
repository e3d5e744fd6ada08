"""Best-fit packing by exact complements.

The plan needs only how many pieces there are of each length, at most
``capacity`` numbers however large the corpus.  Longest length first, pieces
go into the smallest gap that holds them (best fit), and a new bin is opened
where none does.  Equal gaps are served together: as many pieces of the length
as fit share a bin, so that equal pieces are each other's best fit, and where
the sum of none, one, two or three available lengths fills what is left
exactly, it is consumed as often as its counts allow.  Best fit decreasing
without the complements is planned too, and the plan with fewer bins is taken.
The plan is a table of slots (length, ranks from, count, first sequence,
offset).

Pieces then find their slot by their rank among the pieces of their length.
Ranks come from windows over (length, salt) with about sqrt(n) salts, so that
a length that a large part of all pieces have never meets in one task.

Null texts are empty documents: their only token is the end mark.  Repeated
rows are packed as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, text_slices, written
from storelens.llm.wordtext import ChunkCoder, load, tokenizer_file

CAPACITY, END = 2048, 0
_coders: dict[str, ChunkCoder] = {}


def library_coder(key: str, raw: str) -> ChunkCoder:
    """Words are coded by the tokenizers library, each once."""
    if key not in _coders:
        from tokenizers import Tokenizer

        tokenize = Tokenizer.from_str(raw).model.tokenize
        _coders[key] = ChunkCoder(load(raw), lambda w: [t.id for t in tokenize(w)])
    return _coders[key]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, piece int, start long, length long, ids binary): every
    document's ids and the end mark, cut only where it is longer than
    ``capacity``.  ``ids`` are little-endian unsigned 32-bit numbers."""
    raw, key = tokenizer_file(path)
    file = docs.sparkSession.sparkContext.broadcast(raw)  # one vocabulary file
    mark, width = end.to_bytes(4, "little"), 4 * capacity

    def run(batches):
        coder = library_coder(key, file.value)
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                ids, piece, start, found = [], [], [], []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                   strict=True):
                    coded = coder(text) + mark
                    for k, a in enumerate(range(0, len(coded), width)):
                        ids.append(i)
                        piece.append(k)
                        start.append(a // 4)
                        found.append(coded[a:a + width])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in found], pa.int64()),
                     pa.array(found, pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(source, run,
                     f"`{id_col}` long, piece int, start long, length long, ids binary")


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int, exact: bool):
        self.capacity, self.exact = capacity, exact
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.rank = np.zeros(capacity + 1, np.int64)
        self.slots: list[tuple[int, int, int, int, int]] = []
        self.gaps: list[int] = []  # sorted; gap -> groups of equal open bins
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.bins = 0

    def put(self, length: int, n: int, first: int, gap: int) -> None:
        self.slots.append((length, int(self.rank[length]), n, first, self.capacity - gap))
        self.rank[length] += n
        self.left[length] -= n

    def consume(self, combo: tuple[int, ...], first: int, n: int, gap: int) -> int:
        """Puts the combination in as many of the ``n`` bins as its counts allow."""
        k = min(n, *(int(self.left[x]) // m for x, m in Counter(combo).items()))
        if k > 0:
            for x in combo:
                self.put(x, k, first, gap)
                gap -= x
        return k

    def pair(self, total: int) -> np.ndarray:
        """Larger lengths a of the available pairs a + b = total, longest first."""
        if total < 2:
            return np.empty(0, np.int64)
        a = np.arange(total - 1, (total - 1) // 2, -1)
        b = total - a
        return a[(self.left[a] > 0) & (self.left[b] > 0) & ((a != b) | (self.left[a] > 1))]

    def complements(self, gap: int, longest: int):
        """Available combinations with the exact sum ``gap``, none longer than
        ``longest``: nothing, one length, then pairs, then triples; each is
        tested again when it is consumed."""
        if not gap:
            yield ()
            return
        if self.left[gap] > 0:
            yield (gap,)
        if gap <= 2 * longest:
            for a in self.pair(gap).tolist():
                yield a, gap - a
        for a in range(min(gap - 2, longest), (gap + 2) // 3 - 1, -1):
            if self.left[a] > 0:
                for b in self.pair(gap - a).tolist():
                    if b <= a:
                        yield a, b, gap - a - b

    def place(self, length: int, first: int, n: int, gap: int) -> int:
        """Pieces of ``length``, the longest there are, into up to ``n`` equal
        bins from ``first`` with this gap; returns how many bins got some."""
        begin, fit = first, gap // length
        if self.exact:
            for copies in range(fit, 0, -1):
                rest = gap - copies * length
                if rest > 3 * length:  # no three available lengths reach it
                    break
                for combo in self.complements(rest, length):
                    k = self.consume((length,) * copies + combo, first, n, gap)
                    first, n = first + k, n - k
                    if not n or self.left[length] < copies:
                        break
        while n and self.left[length] > 0:
            copies = min(fit, int(self.left[length]))
            k = self.consume((length,) * copies, first, n, gap)
            self.keep(first, k, gap - copies * length)
            first, n = first + k, n - k
        return first - begin

    def keep(self, first: int, n: int, gap: int) -> None:
        """``n`` equal bins from ``first`` stay open with this gap."""
        if gap and n:
            if gap not in self.open:
                self.open[gap] = []
                bisect.insort(self.gaps, gap)
            self.open[gap].append((first, n))

    def run(self) -> _Plan:
        for length in range(self.capacity, 0, -1):
            while self.left[length] > 0:
                i = bisect.bisect_left(self.gaps, length)
                if i < len(self.gaps):  # best fit: the smallest gap that holds it
                    gap = self.gaps[i]
                    first, n = self.open[gap].pop()
                    if not self.open[gap]:
                        del self.open[gap], self.gaps[i]
                    k = self.place(length, first, n, gap)
                    self.keep(first + k, n - k, gap)
                else:
                    self.bins += self.place(length, self.bins, int(self.left[length]), self.capacity)
        return self


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Slots (length, rank from, count, first sequence, offset), sorted."""
    best = min((_Plan(counts, capacity, exact).run() for exact in (True, False)),
               key=lambda p: p.bins)
    return np.array(sorted(best.slots), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with a long ``length`` from 1 to ``capacity``)
    with sequence_id and offset; columns of these two names are replaced.  Rows
    of null or other length are an error."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    columns = ["length" if c == "length" else f"c{i}" for i, c in enumerate(names)]
    kept, _ = written(pieces.select(*[F.col(f"`{c}`") for c in names]).toDF(*columns), "packing-pieces")
    counts = {int(r["length"]): r["n"] for r in
              kept.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    slots = plan(counts, capacity)
    salts = math.isqrt(max(counts.values(), default=0)) + 1
    table = slots.tolist()

    salted = kept.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
    ranked = salted.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_salt").orderBy(*columns)).cast("long") - 1)
    before, _ = written(
        salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
        .withColumn("_before", F.coalesce(F.sum("n").over(
            Window.partitionBy("length").orderBy("_salt")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
        .select("length", "_salt", "_before"), "packing-offsets")
    placed = ranked.join(before, ["length", "_salt"]).withColumn(
        "_rank", F.col("_rank") + F.col("_before")).select(*columns, "_rank")

    def place(batches):
        s = np.array(table, np.int64).reshape(-1, 5)
        base = int(s[:, 1].max(initial=0)) + int(s[:, 2].max(initial=0)) + 1
        key = s[:, 0] * base + s[:, 1]
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(key, batch.column("length").to_numpy() * base + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(s[at, 3] + rank - s[at, 1]),
                 pa.array(s[at, 4])], names=[*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_arrow(placed, place, f"{fields}, sequence_id long, offset long").toDF(
        *names, "sequence_id", "offset")
