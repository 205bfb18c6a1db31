"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into word k-grams; of each window of consecutive k-grams the one with the
smallest hash is kept. These fingerprints form an inverted index. A document's k-grams that are
in the index name (template, diagonal) candidates, and local alignments in a band around the
diagonal report which share of the template is there and where, for each copy in the band.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices

#: Words in a k-gram and k-grams in a window: every shared run of GRAM + WINDOW - 1 words is seen.
GRAM, WINDOW = 3, 3
#: Words that may be added or left out before the alignment leaves its band.
BAND = 12
_words = re.compile(r"[^\W_]+")

#: Notices by license. Texts with a holder or year are given without them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def split(text: str) -> list[str]:
    return _words.findall(text.lower())


def winnow(words: list[str]) -> dict[int, str]:
    """Place and k-gram of each kept fingerprint; of equal hashes the rightmost is kept."""
    grams = [" ".join(words[i : i + GRAM]) for i in range(len(words) - GRAM + 1)]
    hashes = [xxhash.xxh64_intdigest(g) for g in grams]
    kept = {}
    for at in range(max(1, len(hashes) - WINDOW + 1) if hashes else 0):
        best = min(range(at, min(at + WINDOW, len(hashes))), key=lambda i: (hashes[i], -i))
        kept[best] = grams[best]
    return kept


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: split(text) for name, text in templates.items()}
        self.places: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.words.items():
            if len(words) < GRAM + WINDOW - 1:
                raise ValueError(f"template {name} is shorter than {GRAM + WINDOW - 1} words")
            for at, gram in winnow(words).items():
                self.places[gram].append((name, at))
        self.vocabulary = {w for words in self.words.values() for w in words}

    def candidates(self, words: list[str]) -> list[tuple[str, int]]:
        """(template, diagonal) of the document; hits on nearby diagonals close to each other are one."""
        vocabulary, hits, run = self.vocabulary, defaultdict(list), 0
        for at, word in enumerate(words):
            run = run + 1 if word in vocabulary else 0
            if run >= GRAM:
                for name, place in self.places.get(" ".join(words[at - GRAM + 1 : at + 1]), ()):
                    hits[name].append(at - GRAM + 1 - place)
        found = []
        for name, diagonals in hits.items():
            diagonals.sort()
            start = diagonals[0]
            for low, high in zip(diagonals, [*diagonals[1:], None]):
                if high is None or high - start > BAND:
                    found.append((name, (start + low) // 2))
                    start = high
        return found

    def align(self, name: str, diagonal: int, words: list[str], low: int, high: int) -> tuple[int, int, int]:
        """Best local alignment in the band with document words from ``low`` to ``high`` (exclusive).

        Returns matched words, first and last document word (inclusive).
        """
        template = self.words[name]
        width = 2 * BAND + 1
        # state: score, matched words, first and last matched document word
        nothing = (0, 0, -1, -1)
        best, above = nothing, [nothing] * (width + 2)
        for i, wanted in enumerate(template):
            row = [nothing] * (width + 2)
            for k in range(1, width + 1):
                j = diagonal + i + k - 1 - BAND
                if not low <= j < high:
                    continue
                score, matched, first, last = above[k]
                if words[j] == wanted:
                    cell = (score + 2, matched + 1, j if first < 0 else first, j)
                else:
                    cell = (score - 1, matched, first, last)
                for other in (above[k + 1], row[k - 1]):  # a template word, or a document word, left over
                    if other[0] - 1 > cell[0]:
                        cell = (other[0] - 1, *other[1:])
                if cell[0] <= 0:
                    cell = nothing
                row[k] = cell
                best = max(best, cell)
            above = row
        return best[1:]

    def copies(self, name: str, diagonal: int, words: list[str], least: float) -> list[tuple[int, int, int]]:
        """Alignments in the band that cover ``least`` of the template: the best one, then left and right of it."""
        size = len(self.words[name])
        found, left = [], [(max(0, diagonal - BAND), min(len(words), diagonal + size + BAND))]
        while left:
            low, high = left.pop()
            if high - low < max(1, least * size):
                continue
            matched, first, last = self.align(name, diagonal, words, low, high)
            if matched >= max(1, least * size):
                found.append((matched, first, last))
                left += [(low, first), (last + 1, high)]
        return found

    def matches(self, text: str | None, least: float) -> list[dict]:
        """Matches that cover ``least`` of their template, by place; overlaps go to the most words."""
        words = split(text or "")
        found = []
        for name, diagonal in self.candidates(words):
            for matched, first, last in self.copies(name, diagonal, words, least):
                found.append((matched, matched / len(self.words[name]), name, first, last))
        found.sort(key=lambda m: (-m[0], -m[1], m[3], m[2]))
        # kept matches by place: as they do not overlap, only the neighbours can
        kept: list[tuple] = []
        begins: list[int] = []
        for match in found:
            at = bisect(begins, match[4])
            if at == 0 or kept[at - 1][4] < match[3]:
                begins.insert(at, match[3])
                kept.insert(at, match)
        if not kept:
            return []
        # places in the stored text: lower-casing may change lengths, so its own words are counted
        spans = [m.span() for m in _words.finditer(text)]
        if len(spans) != len(words):
            spans = [(-1, -1)] * len(words)
        return [
            {"license": name, "coverage": share, "words": matched, "start": spans[first][0], "end": spans[last][1]}
            for matched, share, name, first, last in kept
        ]


@lru_cache(maxsize=4)
def _index(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, str] | None = None,
    coverage: float = 0.8,
) -> DataFrame:
    """One row (id, matches) per row of ``docs``; ``matches`` is empty where nothing is found.

    A match has the template's name, the share of its words that are there in order, their
    number, and the characters from the first to the last (end exclusive; -1 where lower-casing
    changes the number of words). Whole texts are read, null and empty texts match nothing,
    repeated rows match alike. Templates are a parameter: the index is small and goes with the task.
    """
    given = tuple(sorted((TEMPLATES if templates is None else templates).items()))
    match = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("words", pa.int32()),
                       ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(given)
        for batch in batches:
            for part in slices(batch, 1):
                found = [index.matches(t, coverage) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(match))], ["id", "matches"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    shape = "array<struct<license:string,coverage:double,words:int,start:int,end:int>>"
    source = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return source.mapInArrow(run, f"id {kind}, matches {shape}")


def summary(found: DataFrame, whole: bool = False) -> DataFrame:
    """(id, n_matches, license, coverage, span_start, span_end): the match with the most words; if ``whole``, all ``matches``, too."""
    order = F.transform("matches", lambda m: F.struct(m["words"], m["coverage"], -m["start"], m["license"], m["end"]))
    best = F.array_max(order)
    return found.select(
        "id",
        F.size("matches").cast("bigint").alias("n_matches"),
        best["license"].alias("license"),
        best["coverage"].alias("coverage"),
        (-best["col3"]).cast("bigint").alias("span_start"),
        best["end"].cast("bigint").alias("span_end"),
        *["matches"] * whole,
    )
