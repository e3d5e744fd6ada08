"""Licence scans: sparse TF-IDF cosine to templates, then inheritance.

Every line of a text that shares words with a licence template, and every
window of as many words as the template has, wherever lines are broken, is
compared with the template by the cosine of their TF-IDF vectors; document
frequencies of the templates' words are counted over all lines of the corpus,
and a word that no template has weighs as much as the rarest.  A document's own
licence is its best line's or window's at ``SIMILAR`` or more.  A licence file
is a document with a licence of its own that has the name of one (``FILE_NAME``)
at any length, or at most ``FILE_WORDS`` words; a title (``TITLES``) among the
first ``FILE_WORDS`` words of a file of such a name goes before all else.  A
licence file decides for its directory (highest cosine, then smallest path), and
a document without a licence inherits from the nearest directory above it that
has one.

Null and empty texts have no licence of their own but inherit; a null path
inherits nothing.  Ties between templates go to the first by name.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import map_arrow, text_slices, written

SIMILAR, TITLE_SIMILAR, FILE_WORDS = 0.6, 0.9, 40
FILE_NAME = re.compile(r"(?:.*/)?(?:(?:un)?licen[cs]es?|copying|copyright|notice)(?:[._-][^/]*)?", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
# Headers by which public licences are named (SPDX ids).
TEMPLATES = {
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "SPDX-License-Identifier: Apache-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License",
                     "Redistribution and use in source and binary forms, with or without modification,"
                     " are permitted provided that the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0",
                  "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0",
                     "licensed under a Creative Commons Attribution-NonCommercial 4.0 License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3"],
    "MIT": ["Released under the MIT License", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
# Titles of full licence texts.
TITLES = {
    "AGPL-3.0": "GNU Affero General Public License Version 3", "Apache-2.0": "Apache License Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "CC-BY-4.0": "Creative Commons Attribution 4.0 International",
    "CC-BY-NC-4.0": "Creative Commons Attribution-NonCommercial 4.0 International",
    "CC-BY-SA-4.0": "Creative Commons Attribution-ShareAlike 4.0 International",
    "GPL-2.0": "GNU General Public License Version 2", "GPL-3.0": "GNU General Public License Version 3",
    "LGPL-3.0": "GNU Lesser General Public License Version 3", "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License Version 2.0",
}


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


VOCABULARY = {w for group in [*TEMPLATES.values(), TITLES.values()] for t in group for w in _words(t)}


def _line_counts(batches):
    """Of a task: lines that hold each template word, and all lines (null)."""
    count: Counter = Counter()
    for batch in batches:
        for part in text_slices(batch, "text"):
            for text in part.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    count[None] += 1
                    count.update(VOCABULARY.intersection(_words(line)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
        names=["word", "n"])


class Matcher:
    def __init__(self, counts: dict[str | None, int]):
        lines = counts.get(None, 0)
        self.rare = math.log(1 + lines) + 1
        self.idf = {w: math.log((1 + lines) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}
        self.templates = [(name, self.vector(_words(t)), len(_words(t)))
                          for name in sorted(TEMPLATES) for t in TEMPLATES[name]]
        self.titles = [(name, self.vector(_words(t)), len(_words(t)))
                       for name, t in sorted(TITLES.items())]

    def vector(self, words: list[str]) -> dict[str, float]:
        v = {w: n * self.idf.get(w, self.rare) for w, n in Counter(words).items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / size for w, x in v.items()}

    def windows(self, words: list[str], templates, least: float) -> tuple[str | None, float]:
        """Licence and cosine of the best window, if above ``least``."""
        found, present, weight = None, VOCABULARY.intersection(words), None
        for name, t, size in templates:
            # the words that are there bound every window's cosine
            if sum(x * x for w, x in t.items() if w in present) < least * least:
                continue
            if weight is None:
                weight = np.array([self.idf.get(w, self.rare) for w in words])
                square = np.concatenate([[0.0], np.cumsum(weight * weight)])
            size = min(size, len(words))
            dot = np.concatenate([[0.0], np.cumsum(weight * np.array([t.get(w, 0.0) for w in words]))])
            # repeated words only make a window's vector longer
            bound = (dot[size:] - dot[:-size]) / np.sqrt(square[size:] - square[:-size]) + 1e-9
            for i in np.flatnonzero(bound > least):
                if bound[i] > least:
                    v = self.vector(words[i:i + size])
                    cosine = sum(x * v.get(w, 0.0) for w, x in t.items())
                    if cosine > least + 1e-12:
                        found, least = name, cosine
        return found, least

    def best(self, text: str | None, named: bool = False) -> tuple[str | None, float, int]:
        """Licence, cosine and the text's number of words."""
        found, top, every = None, 0.0, []
        for line in (text or "").split("\n"):
            words = _words(line)
            every += words
            if len(VOCABULARY.intersection(words)) < 2:
                continue
            v = self.vector(words)
            for name, t, _ in self.templates:
                cosine = sum(x * v.get(w, 0.0) for w, x in t.items())
                if cosine >= SIMILAR and cosine > top + 1e-12:
                    found, top = name, cosine
        if every:
            if named:
                title, cosine = self.windows(every[:FILE_WORDS], self.titles, TITLE_SIMILAR)
                if title:
                    return title, cosine, len(every)
            name, cosine = self.windows(every, self.templates, max(top, SIMILAR - 1e-9))
            if name:
                found, top = name, cosine
        return found, top, len(every)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "path") -> DataFrame:
    """Rows (id, path, own_license, similarity, is_license_file, license,
    inherited_from) for every row of ``docs``."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                         F.col(path_col).alias("path"))
    counts = {r["word"]: r["n"] for r in map_arrow(
        source.select("text"), _line_counts, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()}  # the templates' words

    def run(batches):
        matcher = Matcher(counts)
        for batch in batches:
            for part in text_slices(batch, "text"):
                named = [bool(p and FILE_NAME.fullmatch(p)) for p in part.column(2).to_pylist()]
                found = [matcher.best(t, n) for t, n in
                         zip(part.column(1).to_pylist(), named, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()),
                     pa.array([f[0] is not None and (n or f[2] <= FILE_WORDS)
                               for f, n in zip(found, named, strict=True)])],
                    names=["id", "path", "own_license", "similarity", "is_license_file"])

    own, _ = written(map_arrow(
        source, run, "id long, path string, own_license string, similarity double, "
                     "is_license_file boolean"), "license-own")
    folders, _ = written(
        own.where("is_license_file AND instr(path, '/') > 0")
        .withColumn("folder", F.expr("regexp_replace(path, '/[^/]*$', '')"))
        .groupBy("folder").agg(F.min_by(
            "own_license", F.struct(-F.col("similarity"), "path", "own_license")).alias("license")),
        "license-folders")
    # every folder above a document without a licence, once per folder and path
    above = (own.where("own_license IS NULL AND path IS NOT NULL").select("path").distinct()
             .withColumn("parts", F.split("path", "/"))
             .where("size(parts) > 1")
             .select("path", F.explode(F.expr("sequence(1, size(parts) - 1)")).alias("depth"), "parts")
             .select("path", "depth", F.expr("array_join(slice(parts, 1, depth), '/')").alias("folder")))
    inherited, _ = written(
        above.join(folders, "folder").groupBy("path")
        .agg(F.max_by(F.struct("license", "folder"), "depth").alias("from")), "license-inherited")
    return own.join(inherited, "path", "left").select(
        F.col("id").alias(id_col), "path", "own_license", "similarity", "is_license_file",
        F.coalesce("own_license", "from.license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("from.folder")).alias("inherited_from"))
