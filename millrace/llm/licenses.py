"""License notices in documents by conditional compression.

Whole texts are read in windows of `WINDOW_WORDS` words that overlap by more than the longest notice. A word that is cut by a
hyphen at a line's end is one word, and marks that comment lines begin with are none. Templates that cannot hold in a
window, because it lacks too many of their words or one that tells licenses apart, are left out; this loses none. The
window is compressed with each of the others as a zstandard raw dictionary and without one, with equal parameters, and
the bytes a template saves rank the templates. In that order they are confirmed by their exact wording: all places in
the window with few word edits are found, and the words that differ are listed. A license holds if few words differ and
none of them tells licenses apart (a number, or a word such as `noncommercial`). Places found do not overlap: a higher rank
takes its places first, of one template the place with fewer edits.

Every template is tried on every window. A null or empty text has no license. Repeated rows are searched alike. Columns
other than `doc_id` and `text` are not looked at. No documents give no rows.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches

MOST_DIFFERENT = 0.2
WINDOW_WORDS = 256
LEVEL = 6

# fixed values: words that tell licenses apart, next to any word with a digit in it
TELLING = frozenset(
    "mit bsd isc zlib apache mozilla mpl eclipse epl gnu gpl lgpl agpl lesser affero library cc cc0 by sa nc nd noncommercial "
    "sharealike noderivatives noderivs unlicense boost cddl artistic".split()
)
# fixed values: wordings by SPDX identifier
_TEXTS = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT license"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
]
_GNU = [("GPL", "GNU General Public License", "2 3"), ("LGPL", "GNU Lesser General Public License", "2.1 3"), ("AGPL", "GNU Affero General Public License", "3")]
_CC = "BY BY-SA BY-NC BY-ND BY-NC-SA BY-NC-ND".split()
_CC_WORDS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}


def templates() -> list[tuple[str, str]]:
    """SPDX identifier and wording; those of families by rule."""
    out = list(_TEXTS)
    for short, name, versions in _GNU:
        for v in versions.split():
            key = f"{short}-{v if '.' in v else v + '.0'}"
            out.append((key, f"This work is licensed under the {name}, version {v}."))
            out.append((key, f"under the terms of the {name} as published by the Free Software Foundation, either version {v} of the License"))
    for code in _CC:
        for v in ("2.0", "3.0", "4.0"):
            words = "-".join(_CC_WORDS[x] for x in code.split("-"))
            out.append((f"CC-{code}-{v}", f"Licensed under CC {code} {v}."))
            out.append((f"CC-{code}-{v}", f"This work is licensed under a Creative Commons {words} {v} International License"))
    names = sorted({k for k, _ in out})
    return out + [(k, f"SPDX-License-Identifier: {k}") for k in names]


# lines may be empty, and begin with blanks and marks of a comment
_CUT = re.compile(r"-(?:[ \t]*+\r?\n[ \t]*+(?:[#*>;%!/|-]++[ \t]*+)?)+")
_WORD = re.compile(rf"[^\W_]+(?:(?:\.|{_CUT.pattern}|-)[^\W_]+)*")
_READ = 50_000  # words held at a time


def words_in(text: str, known: frozenset[str] = frozenset()) -> Iterator[tuple[str, int, int]]:
    """Words in lower case with their places; hyphens and dots join, so `BY-NC` and `4.0` are words.

    Where a line ends at a hyphen, that belongs to the word unless the word without it is `known`.
    """
    for m in _WORD.finditer(text):
        word = m[0].lower()
        if "\n" in word:
            whole, split = _CUT.sub("-", word), _CUT.sub("", word)
            word = split if split in known and whole not in known else whole
        yield word, m.start(), m.end()


def words_of(text: str) -> list[tuple[str, int, int]]:
    return list(words_in(text, _vocabulary()))


@dataclass
class Template:
    key: str
    text: str
    words: list[str]
    counts: Counter[str]
    telling: set[str]
    some_of: set[str]  # a notice lacks at least one too few of these words to have none
    with_it: zstandard.ZstdCompressor
    saves: int

    def may_be_in(self, text: str) -> bool:
        """Could it be anywhere in a text in lower case, of which no word is cut by a line's end?"""
        return all(w in text for w in self.telling) and any(w in text for w in self.some_of)

    def may_hold(self, counts: Counter[str]) -> bool:
        """Could it hold among words of these counts? Every word that is missing there is an edit."""
        if not all(w in counts for w in self.telling):
            return False
        lacking = sum(max(n - counts[w], 0) for w, n in self.counts.items())
        return lacking <= MOST_DIFFERENT * len(self.words)


def _plain(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8", "replace")


@lru_cache(maxsize=1)
def _library() -> tuple[zstandard.ZstdCompressor, list[Template]]:
    # else the compressor takes other ones with a dictionary than without, and the sizes do not compare
    parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=WINDOW_WORDS * 8)
    alone = zstandard.ZstdCompressor(compression_params=parameters)
    out = []
    for key, text in templates():
        data = _plain(text)
        dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)
        saves = len(alone.compress(data)) - len(packer.compress(data))
        words = [w for w, _, _ in words_in(text)]
        # that many words cannot all be missing; long ones are rare
        some_of = sorted(set(words), key=lambda w: (-len(w), w))[: int(MOST_DIFFERENT * len(words)) + 1]
        out.append(Template(key, text, words, Counter(words), set(filter(_tells, words)), set(some_of), packer, max(saves, 1)))
    return alone, out


@lru_cache(maxsize=1)
def _vocabulary() -> frozenset[str]:
    return frozenset(w for t in _library()[1] for w in t.words)


def edits(template: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every place in `words`: fewest word edits from the template to a run that ends there, and where that begins."""
    n = len(words)
    codes: dict[str, int] = {}
    block = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    cost = np.zeros(n + 1, np.int64)
    begin = np.arange(n + 1)
    steps = np.arange(n + 1)
    for i, word in enumerate(template, 1):
        same = block == codes.get(word, -1)
        best = cost + 1  # the template's word is missing
        start = begin.copy()
        swap = cost[:-1] + ~same
        use = swap <= best[1:]
        best[1:] = np.where(use, swap, best[1:])
        start[1:] = np.where(use, begin[:-1], start[1:])
        # words of the block that the template lacks: least of best[j] + (k - j) over j <= k
        level = best - steps
        low = np.minimum.accumulate(level)
        from_ = np.maximum.accumulate(np.where(level == low, steps, 0))
        cost, begin = low + steps, start[from_]
        assert cost[0] == i
    return cost, begin


def nearest(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """Fewest word edits from the template to any run of `words`, and that run's bounds (the first such run to end)."""
    cost, begin = edits(template, words)
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def places(template: list[str], words: list[str]) -> Iterator[tuple[int, int, int, list[str], list[str]]]:
    """Runs of `words` where the template holds, apart from each other: edits, bounds, words missing and in excess."""
    cost, begins = edits(template, words)
    ends = np.flatnonzero(cost <= MOST_DIFFERENT * len(template))
    taken: list[tuple[int, int]] = []
    for end in ends[np.argsort(cost[ends], kind="stable")].tolist():
        begin = int(begins[end])
        if end <= begin or any(begin < b and a < end for a, b in taken):
            continue
        missing, extra = differing(template, words[begin:end])
        if not any(map(_tells, missing + extra)):
            taken.append((begin, end))
            yield int(cost[end]), begin, end, missing, extra


def differing(template: list[str], words: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that are missing, and words that are there in excess."""
    missing, extra = [], []
    for kind, a, b, c, d in difflib.SequenceMatcher(None, template, words, autojunk=False).get_opcodes():
        if kind != "equal":
            missing += template[a:b]
            extra += words[c:d]
    return missing, extra


def _tells(word: str) -> bool:
    return any(c.isdigit() for c in word) or any(p in TELLING for p in word.split("-"))


@lru_cache(maxsize=1)
def _reach() -> int:
    """Words of the longest run a notice can be."""
    longest = max(len(t.words) for t in _library()[1])
    return longest + int(MOST_DIFFERENT * longest)


def windows(text: str) -> Iterator[list[tuple[str, int, int]]]:
    """Words with their places, in windows: every run as long as a notice can be is whole in one of them."""
    size, step = max(WINDOW_WORDS, 2 * _reach()), max(WINDOW_WORDS, 2 * _reach()) - _reach()
    held: list[tuple[str, int, int]] = []
    for word in words_in(text, _vocabulary()):
        held.append(word)
        if len(held) == _READ + size:
            for at in range(0, _READ, step):
                yield held[at : at + size]
            held = held[len(range(0, _READ, step)) * step :]
    at = 0
    while at + size < len(held):
        yield held[at : at + size]
        at += step
    yield held[at:]


def find_licenses(text: str | None) -> list[tuple[str, int, int, float, list[str], list[str]]]:
    """License, place, part saved, words missing and in excess, in order of place."""
    if not text:
        return []
    alone, library = _library()
    low = text.lower()
    able = library if _CUT.search(low) else [t for t in library if t.may_be_in(low)]
    if not able:
        return []
    sure = []
    for placed in windows(text):
        words = [w for w, _, _ in placed]
        counts = Counter(words)
        here = [t for t in able if t.may_hold(counts)]
        if not here:
            continue
        data = _plain(text[placed[0][1] : placed[-1][2]])
        size = len(alone.compress(data))
        for t in here:
            saved = size - len(t.with_it.compress(data))
            for cost, begin, end, missing, extra in places(t.words, words):
                sure.append((-saved, cost, placed[begin][1], placed[end - 1][2], t.key, saved / t.saves, missing, extra))
    found = []
    starts: list[int] = []
    ends: list[int] = []
    for _, _, begin, end, key, saved, missing, extra in sorted(sure):
        k = bisect.bisect_left(starts, end)  # places taken that begin before this one ends
        if k and ends[k - 1] > begin:
            continue
        starts.insert(k, begin)
        ends.insert(k, end)
        found.append((key, begin, end, saved, missing, extra))
    return sorted(found, key=lambda x: (x[1], x[2], x[0]))


_COLUMNS = "doc_id long, license string, start long, end long, saved double, missing string, extra string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            for name, start, end, saved, missing, extra in find_licenses(text.as_py()):
                rows.append([key.as_py(), name, start, end, round(min(saved, 1.0), 6), " ".join(missing), " ".join(extra)])
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def scan(docs: DataFrame) -> DataFrame:
    """A row for every notice found in `docs(doc_id, text)`: license, place in code points, wording differences."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, _scan, _COLUMNS)
