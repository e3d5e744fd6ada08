"""BPE encoding and decoding with a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merge list can
produce.  It starts as one state with a loop for every base symbol and gets
one *merge gadget* per merge (Berglund, Martens and van der Merwe,
"Constructing a BPE Tokenization DFA", 2024): for ``(u, v) -> w`` the state
after ``u`` is replaced by a copy without the arc ``v``, and wherever ``u``
could be followed by ``v`` an arc ``w`` leads to where ``v`` led.  All arcs of
one token lead to one state, so a state is named by the token read last, and
the copy needs only its difference: the arc it lost and when.  The arcs of a
state are

* own losses: ``lost[u][v]`` = number of the merge that took ``v`` away;
* those inherited: the state after ``w`` was shared with the one after ``v``
  when ``w`` was made, so it has ``v``'s losses up to that merge.

An arc ``t`` is there unless ``t``, or a left part of it no later than it was
extended, had been lost (one merge does both only for ``u = v``, where
``u, uu`` must give way to ``uu, u``).  Every string has exactly one accepted path, so
words are read left to right and each position keeps its one last token.
Decoding emits the arcs' labels, joined by a space as the file (without a
decoder) asks.

Null texts count as empty: no ids, and an empty decoded text.  Texts of any
length are coded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, text_slices
from storelens.llm.wordtext import ChunkCoder, WordBpe, load, tokenizer_file

_NEVER = 1 << 60
STEPS = 200_000  # remembered arc tests


class Automaton:
    """Compiled merges."""

    def __init__(self, model: WordBpe):
        vocab, suffix = model.vocab, model.suffix
        size = max([*vocab.values(), *model.special.values()]) + 1
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        self.lost: dict[int, dict[int, int]] = {}
        self.steps: dict[tuple[int, int], bool] = {}
        self.live = [False] * size
        made = {a + b for a, b in model.merges}
        for s, t in vocab.items():
            self.live[t] = s not in made
        for k, (a, b) in enumerate(model.merges):
            self._gadget(k, vocab[a], vocab[b], vocab[a + b])
        self.steps.clear()
        self.inner = {s: t for s, t in vocab.items() if not s.endswith(suffix) and self.live[t]}
        self.final = {s[:-len(suffix)]: t for s, t in vocab.items()
                      if s.endswith(suffix) and self.live[t]}
        self.starts = {s[:i] for d in (self.inner, self.final) for s in d for i in range(1, len(s) + 1)}
        self.labels = labels(model)

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.live[w] or not (self.live[u] and self.live[v] and self.arc(u, v)):
            return  # no path reads u, v: there is nothing to replace
        self.left[w], self.right[w], self.made[w], self.live[w] = u, v, k, True
        self.lost.setdefault(u, {})[v] = k

    def arc(self, u: int, t: int) -> bool:
        """Whether the state after ``u`` has an arc ``t``."""
        until = _NEVER
        while u >= 0:
            gone = self.lost.get(u)
            if gone:
                x, extended = t, _NEVER
                while x >= 0:
                    when = gone.get(x)
                    if when is not None and when < until and when <= extended:
                        return False
                    extended, x = self.made[x], self.left[x]
            until, u = self.made[u], self.right[u]
        return True

    def step(self, u: int, t: int) -> bool:
        known = self.steps.get((u, t))
        if known is None:
            if len(self.steps) >= STEPS:
                self.steps.clear()
            known = self.steps[u, t] = self.arc(u, t)
        return known

    def word(self, s: str) -> list[int]:
        """The ids of one pre-split word (in byte letters)."""
        whole = self.final.get(s)
        if whole is not None:
            return [whole]
        n, inner, final, starts, step = len(s), self.inner, self.final, self.starts, self.step
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            u = last[i]
            for j in range(i + 1, n + 1):
                part = s[i:j]
                if part not in starts:
                    break
                if last[j] < 0:
                    t = inner.get(part) if j < n else final.get(part)
                    if t is not None and (i == 0 or step(u, t)):
                        last[j], back[j] = t, i
        if last[n] < 0:
            raise ValueError("the tokenizer file lacks a byte's letter")
        out, j = [], n
        while j:
            out.append(last[j])
            j = back[j]
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        return emitted(self.labels, ids)


def labels(model: WordBpe) -> list[str | None]:
    """Every arc's label, by id."""
    out: list[str | None] = [None] * (max([*model.vocab.values(), *model.special.values()]) + 1)
    for s, t in [*model.vocab.items(), *model.special.items()]:
        out[t] = s
    return out


def emitted(of: list[str | None], ids: list[int]) -> str:
    """The labels of the arcs; ids without a label emit nothing."""
    return " ".join(x for i in ids if 0 <= i < len(of) and (x := of[i]) is not None)


_labels: dict[str, list[str | None]] = {}
_compiled: dict[str, tuple[Automaton, ChunkCoder]] = {}


def compiled(key: str, raw: str) -> tuple[Automaton, ChunkCoder]:
    """Compiled once per Python worker and file."""
    if key not in _compiled:
        model = load(raw)
        automaton = Automaton(model)
        _compiled[key] = automaton, ChunkCoder(model, automaton.word)
    return _compiled[key]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded_col: str | None = None) -> DataFrame:
    """Rows (id, ids array<int>) for every row of ``df``; with ``decoded_col``
    also what the ids decode to, in the same pass."""
    raw, key = tokenizer_file(path)
    file = df.sparkSession.sparkContext.broadcast(raw)  # one vocabulary file

    def run(batches):
        automaton, coder = compiled(key, file.value)
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                coded = [coder(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)]).astype(np.int32)
                flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                out = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded_col is not None:
                    out.append(pa.array((automaton.decode(flat[i:j].tolist())
                                         for i, j in zip(ends[:-1], ends[1:], strict=True)), pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=columns)

    columns = [id_col, "ids", *([decoded_col] if decoded_col is not None else [])]
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(source, run, f"`{id_col}` long, ids array<int>"
                     + (f", `{decoded_col}` string" if decoded_col is not None else ""))


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with its column ``ids_col`` decoded into ``text_col``, appended
    (a null list decodes to empty text)."""
    raw, key = tokenizer_file(path)
    file = df.sparkSession.sparkContext.broadcast(raw)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        if key not in _labels:  # only the labels: no automaton is compiled here
            _labels[key] = labels(load(file.value))
        return pa.array((emitted(_labels[key], x.as_py() or []) for x in ids), pa.string())

    return df.withColumn(text_col, text(F.col(ids_col)))
