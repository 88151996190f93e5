"""License scans: winnowed fingerprints pick candidates, banded alignment confirms them.

The templates are a bounded list (a parameter). Their winnowed word k-gram hashes form an
inverted index from hash to (template, position) that is broadcast. A document's
fingerprints are looked up in it; hits of one template on nearby diagonals form a
candidate, which is aligned with the template word by word in a band around the diagonal.
Every document is handled where it is read, so there is no shuffle and no group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import id_and_text, null_ids, worker_cache
from shelfmart.llm.suffix_dedup import BASES, rolling

# Notices by which works state their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software."),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}
KGRAM, WINNOW, BAND = 3, 2, 8
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 1_000_000
CACHE_WORDS = 100_000
_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 11)
        return h


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower())


def winnow(words: list[str], kgram: int = KGRAM, window: int = WINNOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word position) of the smallest k-gram hash of every window (rightmost if tied)."""
    known = worker_cache("license", _Hashes)
    h = rolling(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), kgram, BASES[0])
    if not len(h):
        return h, np.empty(0, np.int64)
    if len(h) <= window:
        at = np.array([len(h) - 1 - int(h[::-1].argmin())])
        return h[at], at
    seen = np.lib.stride_tricks.sliding_window_view(h, window)
    at = np.unique(np.arange(len(seen)) + window - 1 - seen[:, ::-1].argmin(axis=1))
    return h[at], at


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.words = [words_of(templates[n]) for n in self.names]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for h, at in zip(*winnow(words)):
                self.postings.setdefault(int(h), []).append((t, int(at)))
        self.hashes = np.array(sorted(self.postings), np.uint64)


def align(template: list[str], words: list[str], begin: int, end: int, diagonal: int,
          band: int = BAND) -> list[tuple[int, int]]:
    """Matched (template word, document word) pairs of the best local alignment in a band.

    Only cells with |document - template - diagonal| <= band and document words in
    [begin, end) are filled. A match scores 2, a mismatch or gap -1.
    """
    width = 2 * band + 1
    score = [[0] * (width + 2) for _ in range(len(template) + 1)]
    step = [[0] * (width + 2) for _ in range(len(template) + 1)]
    best = (0, 0, 0)
    for i, word in enumerate(template, 1):
        row, above, moves = score[i], score[i - 1], step[i]
        for b in range(width):
            j = i - 1 + diagonal + b - band
            if not begin <= j < end:
                continue
            # along a diagonal the band index stays, above is one to the right
            match = above[b + 1] + (2 if words[j] == word else -1)
            up, left = above[b + 2] - 1, row[b] - 1
            top = max(0, match, up, left)
            row[b + 1] = top
            moves[b + 1] = 0 if top == 0 else 1 if top == match else 2 if top == up else 3
            if top > best[0]:
                best = (top, i, b)
    pairs = []
    _, i, b = best
    while i > 0 and step[i][b + 1]:
        move, j = step[i][b + 1], i - 1 + diagonal + b - band
        if move == 1:
            if words[j] == template[i - 1]:
                pairs.append((i - 1, j))
            i -= 1
        elif move == 2:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return pairs[::-1]


def scan(text: str, index: Index, min_coverage: float) -> list[tuple[str, float, int, int, int, list[tuple[int, int]]]]:
    """(template, coverage, matched words, start, end, spans) of the matches in one text."""
    words = words_of(text)
    hashes, at = winnow(words)
    near = np.flatnonzero(np.isin(hashes, index.hashes))
    if not len(near):
        return []
    hits = sorted((t, int(at[n]) - p, int(at[n])) for n in near for t, p in index.postings[int(hashes[n])])
    found, taken = [], {}
    for t, diagonal, pos in hits:
        template = index.words[t]
        spans = taken.setdefault(t, [])
        begin = max(0, diagonal - BAND)
        end = min(len(words), diagonal + len(template) + BAND)
        while not any(s <= pos < e for s, e in spans):
            pairs = align(template, words, begin, end, diagonal)
            if not pairs or len(pairs) < min_coverage * len(template):
                break
            spans.append((pairs[0][1], pairs[-1][1] + 1))
            found.append((t, len(pairs), [j for _, j in pairs]))
            # the band may hold another copy of a short template: look again between the matches
            begin = max([begin, *(e for _, e in spans if e <= pos)])
            end = min([end, *(s for s, _ in spans if s > pos)])
    # a match inside a larger one of another template says nothing new
    found.sort(key=lambda m: (-m[1], m[0], m[2][0]))
    kept: list[tuple[int, int, list[int]]] = []
    for m in found:
        if not any(k[2][0] <= m[2][0] and m[2][-1] <= k[2][-1] for k in kept):
            kept.append(m)
    if not kept:
        return []
    low = text.lower()
    if len(low) != len(text):                       # a letter whose lower case is longer shifts offsets
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    places = [m.span() for m in _WORD.finditer(low)]
    if len(places) != len(words):
        places = [(min(s, len(text)), min(e, len(text))) for s, e in (m.span() for m in _WORD.finditer(text.lower()))]
    out = []
    for t, n, at_words in sorted(kept, key=lambda m: m[2][0]):
        spans: list[tuple[int, int]] = []
        for k, j in enumerate(at_words):
            if k and at_words[k - 1] == j - 1:
                spans[-1] = (spans[-1][0], places[j][1])
            else:
                spans.append(places[j])
        out.append((index.names[t], n / len(index.words[t]), n, spans[0][0], spans[-1][1], spans))
    return out


SCHEMA = ("doc_id long, no_id boolean, license string, coverage double, matched_words long, start long, end long, "
          "spans array<struct<start: long, end: long>>")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, min_coverage: float = MIN_COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, coverage, matched_words, start, end, spans): a row per match.

    A match covers at least ``min_coverage`` of the template's words in order, with at most
    BAND words more or less in between; every occurrence that shares KGRAM + WINNOW - 1
    words in a row with its template is found. ``spans`` are the character ranges of the
    matched runs of words, ``start`` and ``end`` enclose them. Matches within a larger match
    are left out. Templates of fewer than KGRAM words cannot match. Null and empty texts have
    no match; null ids and repeated rows are scanned like any other; other columns are
    ignored. An empty table gives none.
    """
    index = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, no_id, text in zip(b["doc_id"].tolist(), b["no_id"].tolist(), b["text"]):
                for name, coverage, n, s, e, spans in scan(text or "", index.value, min_coverage):
                    out.append((doc_id, no_id, name, coverage, n, s, e,
                                [{"start": x, "end": y} for x, y in spans]))
            yield pd.DataFrame(out, columns=["doc_id", "no_id", "license", "coverage", "matched_words", "start",
                                             "end", "spans"])

    return null_ids(id_and_text(docs, id_col, text_col).mapInPandas(run, SCHEMA))
