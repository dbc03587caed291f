"""Licence scan: fixed phrases, and a positional index of rare licence words.

Texts are lower-cased (A-Z) and cut into words of letters, digits and all
characters beyond ASCII.  Three fixed phrases are found wherever their words stand
consecutively (base places).  What follows finds licence notices and texts by
their templates:

1. The document frequency of every licence word is counted over all documents.
   A template's words are weighed with their IDF.
2. A template is posted, with positions, under its highest-IDF words: the
   shortest list of its rarest words that a text as alike as ``ALIKE`` can't lack
   altogether (what remains weighs less than ``ALIKE``).  So no find is lost, and
   a file that holds none of the posted words is done.
3. Every place of a posted word in the file says where the template would begin.
   Postings that agree within the drift allowed are intersected to one candidate,
   however many there are; it goes on if the posted words there weigh as much as
   those of any find must.
4. A candidate's words are held against the template's, place by place within the
   drift.  It is a find if the share of the weight is at least ``ALIKE`` and each of
   the licence's mandatory key phrases stands there consecutively.

A general label gives way to a more special one at the same place (``gpl`` to
``gpl-3``).  The score of a document is the largest share of its finds, 1 for a base
place, 0 without any.

Two scans of the texts; between them only one number for each licence word.
Defined results: a null or empty text has no words, no labels and score 0; null
and repeated ids and extra columns do no harm; an empty table gives an empty
result; texts are read whole, whatever their length; of finds with one label and
beginning the longest is kept.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_batches, utf8

#: Fixed phrases and their labels.
BASE = (("under the mit license", "mit"),
        ("apache license version 2", "apache-2"),
        ("cc by nc", "cc-by-nc"))

#: Every ASCII byte that is no letter or digit ends a word.
WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c
              if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
              for c in range(256))
ALIKE = 0.75        # share of a template's weight that a find holds
DRIFT = 0.1         # words that may be inserted or left out, as a share of the template

#: Fixed texts: label, mandatory key phrases, and wordings of the licence.
TEMPLATES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("mit", ("mit license",), (
        "released under the MIT License",
        "licensed under the terms of the MIT License",
        "distributed under the MIT License, see the LICENSE file")),
    ("mit", ("permission is hereby granted free of charge", "without warranty of any kind"), (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",)),
    ("apache-2", ("apache license", "version 2"), (
        "licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")),
    ("bsd", ("redistribution and use in source and binary forms",
             "redistributions of source code must retain"), (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",)),
    ("bsd", ("bsd license",), (
        "released under the BSD License", "licensed under the 3 clause BSD License",
        "use of this source code is governed by a BSD style license that can be found in the "
        "LICENSE file under the BSD License")),
    ("isc", ("permission to use copy modify and or distribute this software",), (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",)),
    ("gpl", ("gnu general public license",), (
        "licensed under the GNU General Public License",
        "released under the terms of the GNU General Public License")),
    ("gpl-2", ("gnu general public license", "version 2"), (
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.")),
    ("gpl-3", ("gnu general public license", "version 3"), (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.")),
    ("lgpl", ("gnu lesser general public license",), (
        "licensed under the GNU Lesser General Public License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation")),
    ("agpl", ("gnu affero general public license",), (
        "licensed under the GNU Affero General Public License",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation")),
    ("mpl-2", ("mozilla public license",), (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
        "licensed under the Mozilla Public License")),
    ("unlicense", ("free and unencumbered software released into the public domain",), (
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software",)),
    ("cc-by-nc", ("creative commons attribution noncommercial",), (
        "licensed under a Creative Commons Attribution NonCommercial 4.0 International License",)),
    ("cc-by-sa", ("creative commons attribution sharealike",), (
        "licensed under a Creative Commons Attribution ShareAlike 4.0 International License",)),
    ("cc-by-nc", ("cc by nc",), ("licensed under CC BY-NC 4.0",)),
    ("cc-by-sa", ("cc by sa",), ("licensed under CC BY-SA 4.0",)),
    ("cc-by", ("creative commons attribution",), (
        "licensed under a Creative Commons Attribution 4.0 International License",)),
    ("cc-by", ("cc by",), ("licensed under CC BY 4.0",)),
    ("cc0", ("cc0",), ("released under CC0 1.0 Universal",
                       "dedicated to the public domain under CC0 1.0")),
)

FIND = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("score", pa.float64())])
FIND_SQL = "struct<label: string, start: long, end: long, score: double>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORDS).split()


def vocabulary() -> list[bytes]:
    """All words of the templates, in order."""
    return sorted({w for _, _, texts in TEMPLATES for t in texts for w in words_of(t.encode())})


def base_places(joined: bytes) -> list[tuple[int, str]]:
    """(word number, label) of every place of a base phrase, in words joined by
    blanks with a blank at both ends."""
    out = []
    for phrase, label in BASE:
        part, at, word, seen = b" %s " % phrase.encode(), 0, 0, 0
        while (at := joined.find(part, at)) >= 0:
            word, seen = word + joined.count(b" ", seen, at), at
            out.append((word, label))
            at += 1
    return sorted(out)


@dataclass
class Template:
    label: str
    keys: list[list[bytes]]
    words: list[bytes]
    weight: list[float]
    total: float = 0.0
    drift: int = 0
    least: float = 0.0          # weight of posted words that any find holds
    posted: set[bytes] = field(default_factory=set)


class Index:
    """Postings of the templates' rarest words, by the document frequencies of all
    licence words among ``n_docs`` documents."""

    def __init__(self, frequency: dict[bytes, int], n_docs: int):
        idf = {w: log((n_docs + 1) / (frequency.get(w, 0) + 1)) + 1e-3 for w in vocabulary()}
        self.templates: list[Template] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for label, keys, texts in TEMPLATES:
            for text in texts:
                words = words_of(text.encode())
                t = Template(label, [words_of(k.encode()) for k in keys], words,
                             [idf[w] for w in words])
                t.total = sum(t.weight)
                t.drift = max(1, round(DRIFT * len(words)))
                number, rest = len(self.templates), t.total
                counts = Counter(words)
                for w in sorted(counts, key=lambda w: (-idf[w], w)):
                    if rest < ALIKE * t.total - 1e-9:
                        break                   # what is left can't make a find
                    t.posted.add(w)
                    rest -= counts[w] * idf[w]
                t.least = ALIKE * t.total - rest - 1e-9
                for p, w in enumerate(words):
                    if w in t.posted:
                        self.postings.setdefault(w, []).append((number, p))
                self.templates.append(t)
        self.rare = self.postings.keys()

    def finds(self, words: list[bytes], base: list[tuple[int, str]] = ()) \
            -> list[tuple[int, int, str, float]]:
        """(start, end, label, share) of the templates found, in words.  ``base`` are
        the places of fixed phrases, before which general labels give way too."""
        rare = self.rare & set(words)
        if not rare:
            return []
        begins: dict[int, list[tuple[int, int]]] = {}
        for at, w in enumerate(words):
            if w in rare:
                for number, p in self.postings[w]:
                    begins.setdefault(number, []).append((at - p, p))
        licence = {w for n in begins for w in self.templates[n].words}
        places: dict[bytes, list[int]] = {w: [] for w in licence}
        for at, w in enumerate(words):
            if w in places:
                places[w].append(at)
        best: dict[tuple[str, int], tuple[int, int, str, float]] = {}
        for number, found in begins.items():
            t = self.templates[number]
            if sum(x for w, x in zip(t.words, t.weight) if places[w]) < ALIKE * t.total:
                continue
            for begin in self._candidates(t, sorted(found)):
                got = self._verify(t, begin, words, places)
                if got and best.get((t.label, got[0]), got)[1] <= got[1]:
                    best[t.label, got[0]] = got
        return self._special(sorted(best.values()), base)

    @staticmethod
    def _candidates(t: Template, begins: list[tuple[int, int]]) -> Iterator[int]:
        """Where the template may begin, by its postings (begin, position); one for all
        beginnings that are at most the drift after it."""
        done = None
        for b, _ in begins:
            if done is None or b > done + t.drift:
                done = b
                lo = bisect_left(begins, (b - t.drift, -1))
                hi = bisect_right(begins, (b + 2 * t.drift, len(t.words)))
                if sum(t.weight[p] for p in {p for _, p in begins[lo:hi]}) >= t.least:
                    yield b

    @staticmethod
    def _verify(t: Template, begin: int, words: list[bytes],
                places: dict[bytes, list[int]]) -> tuple[int, int, str, float] | None:
        held, first, last = 0.0, None, None
        for p, (w, weight) in enumerate(zip(t.words, t.weight)):
            near = places[w]
            at = bisect_left(near, begin + p - t.drift)
            if at < len(near) and near[at] <= begin + p + 2 * t.drift:
                held += weight
                # the place that fits best
                end = bisect_right(near, begin + p + 2 * t.drift)
                place = min(near[at:end], key=lambda x: abs(x - begin - p))
                first = place if first is None else min(first, place)
                last = place if last is None else max(last, place)
        if held < ALIKE * t.total:
            return None
        part = b" %s " % b" ".join(words[first:last + 1])
        if all(b" %s " % b" ".join(k) in part for k in t.keys):
            return first, last + 1, t.label, min(held / t.total, 1.0)
        return None

    @staticmethod
    def _special(found: list[tuple[int, int, str, float]],
                 base: list[tuple[int, str]]) -> list[tuple[int, int, str, float]]:
        """Without the general labels where a more special one stands."""
        special = [(s, e, x) for s, e, x, _ in found if "-" in x]
        special += [(at, at + 1, x) for at, x in base if "-" in x]
        return [f for f in found if not any(
            x.startswith(f[2] + "-") and s < f[1] and f[0] < e for s, e, x in special)]


def frequencies(docs: DataFrame, text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many documents each licence word occurs, and how many there are."""
    known = vocabulary()
    number = {w: i for i, w in enumerate(known)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(known) + 1, np.int64)
        licence = number.keys()
        for batch in batches:
            for text in utf8(batch.column(0)):
                out[-1] += 1
                for w in licence & set(words_of(text)):
                    out[number[w]] += 1
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["word", "n"])

    counted = map_batches(docs.select(text_col), run, "word long, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()     # a row a licence word at most
    got = {r["word"]: r["n"] for r in counted}
    return ({w: got[i] for w, i in number.items() if i in got}, got.get(len(known), 0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base (places of the fixed phrases: start, label), found
    (licences by template: label, start, end, score) and score."""
    index = Index(*frequencies(docs, text_col))
    place = pa.struct([("start", pa.int64()), ("label", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, found, score = [], [], [], []
            for text in utf8(batch.column(1)):
                words = words_of(text)
                places = base_places(b" %s " % b" ".join(words))
                finds = index.finds(words, places)
                counts.append(len(words))
                base.append([{"start": s, "label": x} for s, x in places])
                found.append([{"label": x, "start": s, "end": e, "score": f}
                              for s, e, x, f in finds])
                score.append(1.0 if places else max((f for *_, f in finds), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(base, pa.list_(place)),
                 pa.array(found, pa.list_(FIND)), pa.array(score, pa.float64())],
                names=["doc_id", "n_words", "base", "found", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run,
                       "doc_id long, n_words long, base array<struct<start: long, label: string>>, "
                       f"found array<{FIND_SQL}>, score double")
