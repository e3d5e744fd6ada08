"""Normalization and pre-splitting of a word-BPE tokenizer file (NFC, white
space, lower case; contractions, letter runs, single digits, symbol runs), and
a cache of coded chunks.

A chunk is what stands between white space.  No step of the tokenizer looks
across white space, so a text's ids are its chunks' ids in order; chunks are
coded once and looked up after that.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import regex

# The white space of the tokenizer's patterns, and its splitter.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").replace(r"\s", _WHITE)
_WORDS = regex.compile(_SPLIT)
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^" + "\t\n\x0b\x0c\r " + r"a-z0-9]+")
_GAPS = re.compile(f"[{_WHITE}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to the tokenizer
CACHE = 150_000


@dataclass(frozen=True)
class WordBpe:
    """The parts of a tokenizer file that decide the ids."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    suffix: str


def load(raw: str) -> WordBpe:
    j = json.loads(raw)
    m = j["model"]
    kinds = [x["type"] for x in j["normalizer"]["normalizers"]]
    if m["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or j["decoder"] is not None:
        raise ValueError("a word BPE with NFC, white space and lower case, and no decoder, is expected")
    return WordBpe(m["vocab"], [tuple(x) if isinstance(x, list) else tuple(x.split(" "))
                                for x in m["merges"]],
                   {x["content"]: x["id"] for x in j["added_tokens"]}, m["end_of_word_suffix"])


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_LETTERS = {i: c for i, c in byte_letters().items()}


def chunk_words(chunk: str) -> list[str]:
    """The pre-split words of a chunk, in the file's byte letters."""
    if chunk.isascii() and chunk.isprintable():  # these bytes' letters are themselves
        return _ASCII.findall(chunk.lower())
    # case is mapped letter by letter: no final sigma
    text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
    return [w.encode("utf-8", "surrogatepass").decode("latin-1").translate(_LETTERS)
            for w in _WORDS.findall(text)]


class ChunkCoder:
    """Codes texts chunk by chunk; ``code`` maps a word to a list of ids."""

    def __init__(self, model: WordBpe, code: Callable[[str], list[int]]):
        self.special = model.special
        self.cut = re.compile("|".join(map(re.escape, sorted(model.special, key=len, reverse=True)))
                              or r"(?!)")
        self.code = code
        self.chunks: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, chunk: str) -> bytes | None:
        found = self.chunks.get(chunk)
        if found is None and (found := self.old.get(chunk)) is not None:
            self.chunks[chunk] = found
        return found

    def _keep(self, chunk: str, found: bytes) -> bytes:
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHE:  # the older half is asked once more before it goes
                self.old, self.chunks = self.chunks, {}
            self.chunks[chunk] = found
        return found

    def _word(self, word: str) -> bytes:
        return array("I", self.code(word)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not (chunk.isascii() and chunk.isprintable()):
            return self._keep(chunk, b"".join(map(self._word, chunk_words(chunk))))
        low = chunk.lower()
        words = [low] if low.isalpha() else _ASCII.findall(low)
        out = []
        for w in words:  # an ASCII word is its own chunk
            found = self._known(w)
            out.append(self._keep(w, self._word(w)) if found is None else found)
        found = b"".join(out)
        return found if low == words[0] else self._keep(chunk, found)

    def _plain(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            pieces = [x for x in _GAPS.split(text) if x]
        else:
            pieces = text.split()
        out = list(map(self.chunks.get, pieces))
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    x = self._known(pieces[i])
                    out[i] = self._chunk(pieces[i]) if x is None else x
        return b"".join(out)

    def __call__(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if "<" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out.append(self._plain(text[at:m.start()]))
            out.append(self.special[m.group()].to_bytes(4, "little"))
            at = m.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)


def tokenizer_file(path: str) -> tuple[str, str]:
    """The file's text, read by the driver, and a key for it."""
    import hashlib

    with open(path, encoding="utf-8") as f:
        raw = f.read()
    return raw, hashlib.sha256(raw.encode()).hexdigest()
