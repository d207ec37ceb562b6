"""License scans by patience alignment of documents with license templates: notices and whole license texts.

Words that occur once in the text and once in the template are anchors; the longest increasing subsequence of their
places is kept, and the gaps between neighbouring anchors are aligned in the same way. Only a gap without anchors is
aligned by the longest common subsequence: a small one from a table, a large one from rows of bits. The coverage of a
template is the share of its words that are aligned.

A whole text is scanned. Only the template's words can be aligned, so the others are left out first. Runs of the template's
words have no more than ``GAP`` other words between two of them; runs of ``PART`` words or more are joined over an
interruption as long as the template, so foreign words inside a license do not hide it. A joined run is cut into
overlapping stretches of one and a half template lengths, so a license that occurs twice is found twice and not taken for
one with repeated words; what these leave is cut into stretches of three lengths, for a license among many words of its
own vocabulary. Words are compared in lower case without punctuation at their ends; words of punctuation alone do not
count. A whole license text goes before the notices, which it may quote.

Null and empty texts have no license. Each row is scanned for itself. Ties go to the template that comes first. Of equally
long alignments of a gap without anchors the two ways to align it may take different ones. An empty table gives an empty
result.
"""

from __future__ import annotations

import pkgutil
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortframe.llm.base import query, read

COVERAGE, GAP = 0.8, 6
#: Words of the template in a run that an interruption may join to the next one.
PART = 8
#: Cells of a gap without anchors up to which it is aligned from a table, not from rows of bits.
EXACT_CELLS = 4096

#: Notices of public licenses, in order of preference, then whole license texts.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]
N_NOTICES = len(TEMPLATES)
TEMPLATES += [
    (name, pkgutil.get_data(__package__, f"licenses/{file}.txt").decode())
    for name, file in [
        ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3.0"), ("LGPL", "LGPL-3"), ("LGPL", "LGPL-2.1"), ("BSD", "BSD"),
        ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("Unlicense", "Unlicense"), ("ISC", "ISC"),
    ]
]
_ENDS = ".,;:!?()[]{}<>\"'`*#|/\\-_=+~"


def plain_words(text: str | None) -> list[str]:
    """Lower-case words without punctuation at the ends; a word of punctuation alone stays as an empty one."""
    return [w.strip(_ENDS) for w in (text or "").lower().split()]


def _exact(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places."""
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            n[i][j] = n[i + 1][j + 1] + 1 if a[i] == b[j] else max(n[i + 1][j], n[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif n[i + 1][j] >= n[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _exact_by_bits(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The same by rows of bits: bit j of row i is 0 where the first i + 1 and j + 1 words have one more in common than those and j."""
    full = (1 << len(b)) - 1
    where: dict[str, int] = {}
    for j, w in enumerate(b):
        where[w] = where.get(w, 0) | 1 << j
    rows, row = [], full
    for w in a:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append((i, j))
    return out[::-1]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first place, whose second places increase."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back[k] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of two lists of words."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if cb[w] == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if ca[w] == 1 and w in place])
        if not anchors:
            exact = _exact if (a1 - a0) * (b1 - b0) <= EXACT_CELLS else _exact_by_bits
            out += [(a0 + i, b0 + j) for i, j in exact(a[a0:a1], b[b0:b1])]
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def _tight(words: list[str], places: list[int]) -> tuple[int, int]:
    """First place and end of an alignment whose words are moved together: to the right from its end, then to the left."""
    for k in range(len(places) - 2, -1, -1):
        i = places[k + 1] - 1
        while words[i] != words[places[k]]:
            i -= 1
        places[k] = i
    for k in range(1, len(places)):
        i = places[k - 1] + 1
        while words[i] != words[places[k]]:
            i += 1
        places[k] = i
    return places[0], places[-1] + 1


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE, gap: int = GAP):
        self.coverage, self.gap = coverage, gap
        #: Ranks of the whole license texts.
        self.whole = {k for k, t in enumerate(templates) if t in TEMPLATES[N_NOTICES:]}
        self.templates = [(name, [w for w in plain_words(text) if w]) for name, text in templates]
        self.vocabulary = {w for _, words in self.templates for w in words}
        self.counts = [Counter(words) for _, words in self.templates]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, end) of each place found, best first; places do not overlap."""
        words = plain_words(text)
        at = [i for i, w in enumerate(words) if w]  # rulers and comment marks part nothing
        words = [words[i] for i in at]
        vocabulary = self.vocabulary
        hits = [i for i, w in enumerate(words) if w in vocabulary]
        if not hits:
            return []
        seen = {words[i] for i in hits}
        found = []
        for rank, ((name, template), own) in enumerate(zip(self.templates, self.counts)):
            need = self.coverage * len(template)
            if sum(own[w] for w in own.keys() & seen) < need:
                continue
            mine = [i for i in hits if words[i] in own]
            for run in self._runs(mine, len(template), need):
                found += self._places([words[i] for i in run], run, name, template, rank, need)
        found.sort(key=lambda f: (f[5] not in self.whole, -f[1], -f[4], f[5], f[2]))
        taken: list[tuple[int, int]] = []
        out = []
        for name, share, begin, end, _, _ in found:
            if all(end <= b or begin >= e for b, e in taken):
                taken.append((begin, end))
                out.append((name, share, at[begin], at[end - 1] + 1))
        return out

    def _runs(self, mine: list[int], length: int, need: float) -> Iterator[list[int]]:
        """Places of the template's words in runs that can reach the coverage, joined over interruptions."""
        cuts = [0, *(k for k in range(1, len(mine)) if mine[k] - mine[k - 1] > self.gap + 1), len(mine)]
        solid = [(a, b) for a, b in zip(cuts, cuts[1:]) if b - a >= min(PART, need)]
        joined: list[tuple[int, int]] = []
        for a, b in solid:
            if joined and mine[a] - mine[joined[-1][1] - 1] <= length + 1:
                joined[-1] = joined[-1][0], b
            else:
                joined.append((a, b))
        return (mine[a:b] for a, b in joined if b - a >= need)

    def _places(self, words: list[str], at: list[int], name: str, template: list[str], rank: int, need: float) -> list[tuple]:
        """What the stretches of a run find; wide stretches look only where the narrow ones found nothing."""
        half = max(1, len(template) // 2)
        found = list(self._stretches(words, 0, len(words), template, 3 * half + 2, half, need))
        last = 0
        free = []
        for begin, end, _ in [*sorted(found), (len(words), len(words), 0)]:
            free.append((last, begin))
            last = max(last, end)
        for begin, end in free if len(words) > 3 * half + 2 else []:
            if end - begin >= need:
                found += self._stretches(words, begin, end, template, 6 * half, 3 * half, need)
        return [(name, n / len(template), at[begin], at[end - 1] + 1, n, rank) for begin, end, n in found]

    @staticmethod
    def _stretches(words: list[str], begin: int, end: int, template: list[str], size: int, step: int, need: float) -> Iterator[tuple[int, int, int]]:
        for at in range(begin, max(begin + 1, end - step), step):
            pairs = align(words[at : min(end, at + size)], template)
            if len(pairs) >= need:
                begin_at, end_at = _tight(words, [at + i for i, _ in pairs])
                yield begin_at, end_at, len(pairs)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: id, license (best, null if none), coverage, n_found, places (license, first word, end)."""
    place = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in batches:
            all_found = [scanner.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([f[0][0] if f else None for f in all_found], pa.string()),
                    pa.array([f[0][1] if f else 0.0 for f in all_found], pa.float64()),
                    pa.array([len(f) for f in all_found], pa.int64()),
                    pa.array([[dict(zip(("license", "coverage", "begin", "end"), x)) for x in f] for f in all_found], pa.list_(place)),
                ],
                names=[id_col, "license", "coverage", "n_found", "places"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, license string, coverage double, n_found bigint, "
        "places array<struct<license:string,coverage:double,begin:bigint,end:bigint>>",
    )


@query("op8_license_scan")
def op8_license_scan(spark, sf_dir):
    """All documents against all templates."""
    return license_scan(read(spark, sf_dir, "documents"))
