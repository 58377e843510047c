"""License scans by patience alignment of texts with license templates.

A window of a text is a candidate for a template if enough of its words stand in
the template at all; counts over sliding windows find these without aligning
anything, and no match of the wanted coverage is lost: it holds that many.  A
candidate is aligned by patience: words that are unique on both sides are
anchors, the longest increasing subsequence of their places is kept, and the
gaps between are aligned the same way, their equal ends where no word is unique.
Matched words far from the rest are let go.
Coverage is the share of the template that is matched; the words and numbers that
name its license are matched all, and the span names no variant.  Of overlapping matches
the one with the greatest share of both sides stays.

Words are runs of letters and digits, A-Z folded.  Defined cases: null and empty
texts have no license; a license found twice is two matches of one name; equal
scores go to the longer match, then to the template's place in the table;
repeated rows agree; an empty table gives an empty one; extra columns travel
inside ``row``.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import ALNUM, Words, lex, parts

_WORD = re.compile(r"[a-z0-9]+")

# Names and notices of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License "
        "at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name "
        "of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Share of a template that a match covers, and of the matched span that is the template's.
COVERAGE, DENSITY = 0.8, 0.7
# Words that tell a license from its kin, beside numbers; a match has all that its template has ...
NAMING = frozenset("mit apache gnu lesser affero general mozilla cc by nc nd sa creative commons attribution sharealike noncommercial waived unencumbered domain".split())
#: ... and of these no other.
QUALIFIERS = frozenset("lesser affero nc nd sa sharealike noncommercial noderivatives noderivs".split())
#: Templates of more words are told apart by their wording; only their names and numbers count, not "by" or "general" in prose.
SHORT = 30


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, of pairs by rising first, that rises in the second: patience piles."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect.bisect_left(tops, y)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            ends.append(i)
        else:
            tops[pile], ends[pile] = y, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places of two word lists, rising on both sides."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        na, nb = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        at = {b[j]: j for j in range(blo, bhi) if nb[b[j]] == 1}
        anchors = _increasing([(i, at[a[i]]) for i in range(alo, ahi) if na[a[i]] == 1 and a[i] in at])
        if anchors:
            x, y = alo, blo
            for i, j in anchors:
                out.append((i, j))
                todo.append((x, i, y, j))
                x, y = i + 1, j + 1
            todo.append((x, ahi, y, bhi))
    return sorted(out)


def compact(pairs: list[tuple[int, int]], a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """The run of pairs that is densest in ``a``, grown by equal neighbours.

    A pair counts 1, a word of ``a`` that is skipped between pairs costs 1/2; so
    a stray common word far before or after the rest doesn't stretch a match.
    """
    best, first, total, start = 0.0, (0, 0), 0.0, 0
    for i, (x, _) in enumerate(pairs):
        gap = (x - pairs[i - 1][0] - 1) / 2 if i else 0.0
        total, start = (total - gap + 1, start) if total > gap else (1.0, i)
        if total > best:
            best, first = total, (start, i + 1)
    run = pairs[slice(*first)]
    while run and run[0][0] and run[0][1] and a[run[0][0] - 1] == b[run[0][1] - 1]:
        run.insert(0, (run[0][0] - 1, run[0][1] - 1))
    while run and run[-1][0] + 1 < len(a) and run[-1][1] + 1 < len(b) and a[run[-1][0] + 1] == b[run[-1][1] + 1]:
        run.append((run[-1][0] + 1, run[-1][1] + 1))
    return run


class Scanner:
    """Templates as symbols, with the windows that may hold them."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE, density: float = DENSITY):
        words = ALNUM.words([*(text for _, text in templates), " ".join(sorted(QUALIFIERS))])
        self.vocabulary, symbols = np.unique(words.hash, return_inverse=True)
        bounds = words.bounds()
        self.names = [name for name, _ in templates]
        *self.symbols, qualifiers = [symbols[lo:hi].tolist() for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        self.needed = []
        for (_, text), own in zip(templates, self.symbols, strict=True):
            plain = [w for w in _WORD.findall(text.lower())]
            names = NAMING if len(own) <= SHORT else NAMING & {"mit", "apache", "gnu", "lesser", "affero", "mozilla"}
            self.needed.append({x for w, x in zip(plain, own, strict=True) if w in names or w.isdigit()})
        self.qualifiers = set(qualifiers)
        self.member = np.zeros((len(templates), len(self.vocabulary) + 1), np.int8)
        for t, own in enumerate(self.symbols):
            self.member[t, own] = 1
        self.coverage, self.density = coverage, density

    def scan(self, words: Words) -> list[list[tuple[int, int, str, float]]]:
        """Per text: (first word, last word + 1, name, coverage) of each match, in order."""
        found: list[list[tuple[float, int, int, int, int, float]]] = [[] for _ in range(words.rows)]
        n = len(words.row)
        if n:
            at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
            at = np.where(self.vocabulary[at] == words.hash, at, len(self.vocabulary))
            bounds = words.bounds()
            # only words near others of some template matter: most of a text is none
            for t, own in enumerate(self.symbols):
                inside = self.member[t][at]
                sums = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
                least = math.ceil(self.coverage * len(own))
                width = math.floor(len(own) / self.density)  # a denser match is no longer
                start = np.flatnonzero(inside)
                stop = np.minimum(start + width, bounds[words.row[start] + 1])
                start = start[sums[stop] - sums[start] >= least]
                done = -1
                for i in start.tolist():
                    if i < done:
                        continue
                    while True:
                        body = at[i : min(i + width, int(bounds[words.row[i] + 1]))].tolist()
                        pairs = compact(patience(body, own), body, own)
                        if len(pairs) < least or not pairs[0][0]:
                            break
                        i += pairs[0][0]  # the window starts where the match does, so its end isn't cut off
                    if len(pairs) < least:
                        continue
                    lo, end = i + pairs[0][0], i + pairs[-1][0] + 1
                    if len(pairs) < self.density * (end - lo):
                        continue
                    if need := self.needed[t]:
                        matched = {own[y] for _, y in pairs}
                        if need - matched or self.qualifiers & set(body[pairs[0][0] : pairs[-1][0] + 1]) - matched:
                            continue
                    done = end
                    share = len(pairs) / max(end - lo, len(own))
                    found[int(words.row[i])].append((-share, -len(pairs), t, lo, end, len(pairs) / len(own)))
        out = []
        for row, matches in enumerate(found):
            kept: list[tuple[int, int, str, float]] = []
            first = int(bounds[row]) if matches else 0
            for _, _, t, lo, end, covered in sorted(matches):
                if all(end - first <= a or lo - first >= b for a, b, _, _ in kept):
                    kept.append((lo - first, end - first, self.names[t], covered))
            out.append(sorted(kept))
        return out


def scan(df: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``row``, the input row as a struct, and ``licenses``: structs of name, coverage, first and last word, first and last byte."""
    scanner = Scanner(templates, coverage)
    field = df.columns.index(text)
    rows = df.select(F.struct("*").alias("row"))
    kind = T._parse_datatype_string("licenses array<struct<name:string,coverage:double,first_word:bigint,n_words:bigint,start:bigint,end:bigint>>").fields
    arrow = pa.list_(pa.struct([("name", pa.string()), ("coverage", pa.float64()), *((n, pa.int64()) for n in ("first_word", "n_words", "start", "end"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column(0), [field])
            for lo, hi in parts(texts, 2 << 20):
                words = lex(ALNUM, texts.slice(lo, hi - lo))
                bounds = words.bounds()
                out = [
                    [
                        {"name": n, "coverage": c, "first_word": a, "n_words": b - a, "start": int(words.start[bounds[i] + a]), "end": int(words.end[bounds[i] + b - 1])}
                        for a, b, n, c in own
                    ]
                    for i, own in enumerate(scanner.scan(words))
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(out, arrow)], names=["row", "licenses"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *kind]))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document states."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("licenses.name")), ",").alias("licenses"),
        F.coalesce(F.array_max("licenses.coverage"), F.lit(0.0)).alias("coverage"),
        F.aggregate("licenses", F.lit(0).cast("long"), lambda n, x: n + x["n_words"]).alias("n_words"),
    )
