"""License scans: winnowed fingerprints pick candidates, banded alignment reports what matches.

Templates are cut into word k-grams and winnowed; an inverted index leads from a fingerprint to the templates
and places that have it. Fingerprints of a document that fall on one diagonal band of a template make a
candidate, and a local alignment inside that band gives the matched words of the template and their span in
the document. A task keeps the templates, which are few and whose total size is checked, and one text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.llm.text import NOT_ALNUM, Texts, slices, window_hashes

GRAM = 3
WINDOW = 2
BAND = 12
LEAST_COVERAGE = 0.6
WIDEST = 256
MAX_TEMPLATE_BYTES = 16 << 20

# License notices as they are commonly written
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("BSD-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met."),
    ("Apache-2.0-notice", "Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("All-rights-reserved", "All rights reserved. No part of this publication may be reproduced without permission."),
)


def whole_texts() -> tuple[tuple[str, str], ...]:
    """Whole texts of public licenses, named ``<license>-text``; the driver alone reads their files."""
    files = sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
    return tuple((f"{file.stem}-text", file.read_text(encoding="utf-8")) for file in files)


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash, the rightmost of equal ones, in every run of ``window`` hashes."""
    if not len(h):
        return np.zeros(0, np.int64)
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))])
    runs = np.lib.stride_tricks.sliding_window_view(h[::-1], window)
    least = np.arange(len(runs)) + runs.argmin(axis=1)
    return np.unique(len(h) - 1 - least)


class Index:
    """Fingerprints of the templates, sorted, with template and place."""

    def __init__(self, templates: Sequence[tuple[str, str]], gram: int, window: int):
        if sum(len(text.encode()) for _, text in templates) > MAX_TEMPLATE_BYTES:
            raise ValueError("the templates exceed MAX_TEMPLATE_BYTES; scan with parts of them in turn")
        self.names = [name for name, _ in templates]
        words = Texts.of(pa.array([text for _, text in templates], pa.string()), fold=True).words(NOT_ALNUM)
        h = words.hashes()
        self.words = [h[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.gram, self.window = gram, window
        prints, which, place = [], [], []
        for i, own in enumerate(self.words):
            grams = fingerprints(own, gram)
            at = winnow(grams, window)
            prints.append(grams[at])
            which.append(np.full(len(at), i))
            place.append(at)
        every = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.prints = every[order]
        self.which = np.concatenate(which)[order] if which else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)


def fingerprints(words: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of the word k-grams; a shorter text is one gram of all its words."""
    if not len(words):
        return words
    owner = np.zeros(len(words), np.int64)
    return window_hashes(words, owner, min(gram, len(words)))[0]


def align(template: np.ndarray, part: np.ndarray, middle: int, band: int) -> tuple[int, int, int]:
    """Local alignment of words within ``band`` of the diagonal ``middle`` (place in part less in template).

    Matches count 2, other steps -1. Returns matched words, and the first and last word of ``part`` matched;
    of equal scores the earliest end wins. Time and memory are words of the template times the band.
    """
    width = 2 * band + 1
    score = np.zeros((len(template) + 1, width + 1), np.int64)
    step = np.zeros((len(template) + 1, width + 1), np.int8)
    top, end, across = 0, (0, 0), np.arange(width)
    for i in range(1, len(template) + 1):
        j = i + middle + across - band  # words of part, counted from 1
        a, b = np.searchsorted(j, (1, len(part) + 1))
        if a == b:
            continue
        diagonal = score[i - 1, a:b] + np.where(part[j[a:b] - 1] == template[i - 1], 2, -1)
        above = score[i - 1, a + 1 : b + 1] - 1
        best = np.maximum(np.maximum(diagonal, above), 0)
        value = np.maximum.accumulate(best + across[a:b]) - across[a:b]  # steps along the row cost 1 each
        score[i, a:b] = value
        step[i, a:b] = np.select([value == 0, value == diagonal, value == above], [0, 1, 2], 3)
        k = a + int(value.argmax())
        if score[i, k] > top:
            top, end = score[i, k], (i, k)
    i, k = end
    matched, first, last = 0, -1, -1
    while i > 0 and step[i, k]:
        j = i + middle + k - band
        if step[i, k] == 1:
            if template[i - 1] == part[j - 1]:
                matched, first, last = matched + 1, j - 1, max(last, j - 1)
            i -= 1
        elif step[i, k] == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return matched, first, last


def matches(words: np.ndarray, index: Index, band: int, least: float) -> list[tuple[int, int, int, int]]:
    """``(template, matched, first, last)`` of every occurrence in a text, overlapping ones of a template once."""
    grams = fingerprints(words, index.gram)
    low = np.searchsorted(index.prints, grams, side="left")
    times = np.searchsorted(index.prints, grams, side="right") - low
    hit = np.flatnonzero(times)
    if not len(hit):
        return []
    at = np.repeat(hit, times[hit])
    entry = np.concatenate([np.arange(low[i], low[i] + times[i]) for i in hit])
    which, diagonal = index.which[entry], at - index.place[entry]
    found = []
    for t in np.unique(which):
        template = index.words[t]
        if len(words) < least * len(template) or np.count_nonzero(np.isin(template, words)) < least * len(template):
            continue  # too few words to reach the coverage anywhere
        own = np.flatnonzero(which == t)
        own = own[np.argsort(diagonal[own], kind="stable")]
        gram = min(index.gram, len(words))
        places = occurrences(template, words, at[own], diagonal[own], 0, len(words), gram, band, least)
        found += [(int(t), *place) for place in places]
    return found


def occurrences(template: np.ndarray, words: np.ndarray, at: np.ndarray, line: np.ndarray, low: int, high: int,
                gram: int, band: int, least: float) -> list[tuple[int, int, int]]:
    """``(matched, first, last)`` of the template's occurrences inside words ``low`` to ``high``, from the left.

    ``at`` are the places of shared grams and ``line`` their diagonals, ascending. Diagonals that follow each
    other within ``band``, over no more words than an alignment can skip, are aligned together; after a
    match the words before it and behind it are searched, without one the next diagonal begins. Where they
    spread far, as they do for a text of thousands of words, the stretch with most shared grams is aligned. For a
    template of over ``WIDEST`` words a stretch needs one shared gram for each twenty of its words (about a tenth
    of its fingerprints), and one that does not match is passed over whole.
    """
    found, i, spread, widest = [], 0, max(band, 2 * len(template)), max(WIDEST, len(template) // 16)
    while i < len(line):
        if not low <= at[i] <= high - gram:
            i += 1
            continue
        stop = i + int(np.searchsorted(line[i:], line[i] + spread, side="right"))
        inside = line[i:stop][(at[i:stop] >= low) & (at[i:stop] <= high - gram)]
        apart = np.flatnonzero(np.diff(inside) > band)
        chain = inside[: apart[0] + 1] if len(apart) else inside
        densest = 0
        if chain[-1] - chain[0] > widest:
            ends = np.searchsorted(chain, chain + widest, side="right")
            densest = int((ends - np.arange(len(chain))).argmax())
            chain = chain[densest : ends[densest]]
        if len(template) > WIDEST and 20 * len(chain) < len(template):
            i += int(np.searchsorted(line[i:], (inside[apart[0]] if len(apart) else inside[-1]), side="right"))
            continue
        lines = np.unique(chain)
        begin = max(int(lines[0]) - band, low)
        part = words[begin : min(int(lines[-1]) + len(template) + band, high)]
        matched = 0
        if np.count_nonzero(np.isin(template, part)) >= least * len(template):
            reach = max(band, int(lines[-1] - lines[0]))
            matched, first, last = align(template, part, int(lines[len(lines) // 2]) - begin, reach)
        if matched and matched >= least * len(template):
            first, last = begin + first, begin + last
            until = i + int(np.searchsorted(line[i:], first, side="left"))
            found += occurrences(template, words, at[i:until], line[i:until], low, first, gram, band, least)
            found.append((matched, first, last))
            low = last + 1
        elif len(template) > WIDEST:
            other = (line < lines[0]) | (line > lines[-1])
            at, line = at[other], line[other]
        else:
            i += int(np.searchsorted(line[i:], line[i], side="right"))
    return found


def outermost(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """``found`` without occurrences of which over half lies inside one with more matched words of another template.

    Of equally well matched ones the earlier template stays. Both lists are in the order of ``matches``.
    """
    best = sorted(found, key=lambda f: (-f[1], f[0], f[2]))
    firsts, lasts = np.array([f[2] for f in best]), np.array([f[3] for f in best])
    which, stays = np.array([f[0] for f in best]), np.ones(len(best), bool)
    for i, (t, _, first, last) in enumerate(best):
        inside = np.minimum(lasts[:i], last) - np.maximum(firsts[:i], first) + 1
        stays[i] = not np.any(stays[:i] & (which[:i] != t) & (2 * inside > last - first + 1))
    return sorted(f for f, s in zip(best, stays) if s)


def scan(docs: DataFrame, key: str | Column = "doc_id", templates: Sequence[tuple[str, str]] = TEMPLATES,
         gram: int = GRAM, window: int = WINDOW, band: int = BAND, least: float = LEAST_COVERAGE) -> DataFrame:
    """``key``, ``license``, ``coverage``, ``matched_words``, ``first_word``, ``last_word``, ``matched_text``.

    One row for each occurrence of a template of which at least the share ``least`` is matched; words are
    runs of letters and digits, counted from 0, with A to Z lower-cased. Null and empty texts have none;
    repeated rows are reported for each. A winnowed index finds every shared run of ``gram`` + ``window`` - 1
    words. Notices side by side each have a row, however near; spans of one template do not overlap. Where templates
    are nested, as a notice in a whole license, or alike, as two versions of it, the one with more matched words is reported.
    """
    index = docs.sparkSession.sparkContext.broadcast(Index(templates, gram, window))
    inner = docs.select(F.col(key).alias("k") if isinstance(key, str) else key.alias("k"), "text")
    name = key if isinstance(key, str) else "key"
    kind = inner.schema["k"].dataType.simpleString()
    ddl = f"`{name}` {kind}, license string, coverage double, matched_words long, first_word long, last_word long, matched_text string"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = index.value
        for part in slices(batches):
            raw = Texts.of(part.column("text"))
            words = Texts.of(part.column("text"), fold=True).words(NOT_ALNUM)
            h = words.hashes()
            rows: list[tuple] = []
            origin: list[int] = []
            for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                for t, matched, first, last in outermost(matches(h[a:b], book, band, least)):
                    text = raw.data[words.start[a + first] : words.end[a + last]].tobytes().decode("utf-8", "replace")
                    rows.append((book.names[t], matched / len(book.words[t]), matched, first, last, text))
                    origin.append(i)
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [part.column("k").take(pa.array(origin, pa.int64())), *[pa.array(list(c), x) for c, x in zip(columns, kinds)]],
                names=[name, "license", "coverage", "matched_words", "first_word", "last_word", "matched_text"],
            )

    return inner.mapInArrow(scanned, ddl)
