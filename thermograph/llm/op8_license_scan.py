"""License scan: winnowed template fingerprints, then banded alignment.

Templates (``TEMPLATES``) and texts are word sequences: A-Z lower-cased,
ASCII signs are separators.  Every window of ``K`` words has a hash; of each
``W`` consecutive hashes of a template the smallest is kept in an inverted
index (hash -> template, position), so any ``K + W - 1`` words that a text has
in common with a template contain an indexed hash.  The index is as large as
the template texts, whatever the input, and goes to every task.

A text's hits are grouped by template into bands of neighbouring diagonals, and
each band is aligned with its template (Smith-Waterman, +2 / -1 / -1, up to an
eighth of the template's words, 2 to ``BAND``, off the hits' diagonals).  A span is reported if the words
matched are ``COVERAGE`` % or more of the template's; of overlapping spans the
one with more matched words stays (ties: higher coverage, then the template's
place in the list).

Each text is scanned in its own row: nothing is shuffled.  Only texts with a hit
are looked at one by one.

Nulls: a null text is an empty one, without spans.  Null and repeated ids are
kept, one row per input row.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.llm._text import Words, text_slices, windows

K, W = 3, 2
BAND = 12
COVERAGE = 75

# Public license notices (fixed values): SPDX-like name, text.
TEMPLATES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License "
     "at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
     "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation; "
     "either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under "
     "the terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU Affero General Public License as published by the Free Software "
     "Foundation."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met: "
     "Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. Redistributions in binary form must reproduce the "
     "above copyright notice, this list of conditions and the following disclaimer in the "
     "documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors "
     "may be used to endorse or promote products derived from this software without specific "
     "prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
     "with or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms "
     "of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and "
     "related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial "
     "4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("proprietary", "All rights reserved."),
)

_WORD = np.full(256, 0x20, np.uint8)
_WORD[0x80:] = np.arange(0x80, 256)
for _low, _high, _to in ((0x30, 0x3A, 0x30), (0x61, 0x7B, 0x61), (0x41, 0x5B, 0x61)):
    _WORD[_low:_high] = np.arange(_to, _to + _high - _low)


def split(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(texts, table=_WORD)
    return words, words.hashes()


class Index:
    """Templates' words and the inverted index of their fingerprints."""

    def __init__(self, templates=TEMPLATES):
        self.names = [name for name, _ in templates]
        words, h = split(pa.array([text for _, text in templates], pa.large_string()))
        self.words = [h[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        grams, at = windows(h, words.doc, K)
        of = words.doc[at]
        place = defaultdict(set)
        for t in range(len(templates)):
            own = grams[of == t]
            for i in range(max(len(own) - W + 1, min(len(own), 1))):
                least = i + int(np.argmin(own[i:i + W]))
                place[int(own[least])].add((t, least))
        self.keys = np.array(sorted(place), np.uint64)
        self.places = [sorted(place[int(k)]) for k in self.keys]

    def look(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices of grams in the index, their keys' numbers)."""
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == grams)
        return hit, at[hit]


def align(template: list[int], text: list[int], low: int, high: int) -> tuple[int, int, int]:
    """(matched words, first, end) of the best local alignment with diagonals
    (text position - template position) in low .. high; 0 matches: none."""
    width = high - low + 1
    none = (0, 0, 0)
    score, trace = [0] * (width + 2), [none] * (width + 2)
    best, found = 0, none
    for i, word in enumerate(template):
        new, path = [0] * (width + 2), [none] * (width + 2)
        for d in range(width):
            j = i + low + d
            if not 0 <= j < len(text):
                continue
            equal = text[j] == word
            s, t = score[d + 1] + (2 if equal else -1), trace[d + 1]
            up, left = score[d + 2] - 1, new[d] - 1
            if s >= up and s >= left:
                if s > 0:
                    m, a, _ = t
                    t = (m + 1, a if m else j, j + 1) if equal else t
            elif up >= left:
                s, t = up, trace[d + 2]
            else:
                s, t = left, path[d]
            if s > 0:
                new[d + 1], path[d + 1] = s, t
                if s > best or s == best and t[0] > found[0]:
                    best, found = s, t
        score, trace = new, path
    return found


def scan(text: list[int], hits: list[tuple[int, int]], index: Index) -> list[tuple]:
    """(first word, end, template, matched words) of a text's license spans;
    ``hits``: (text position, key's number)."""
    by_template = defaultdict(list)
    for p, key in hits:
        for t, i in index.places[key]:
            by_template[t].append(p - i)
    found = []
    for t, own in by_template.items():
        template = index.words[t]
        # Narrow for short templates: a notice may stand several times in a row.
        band = min(BAND, max(2, len(template) // 8))
        groups: list[list[int]] = []
        for d in sorted(set(own)):
            if groups and d - groups[-1][0] <= band:
                groups[-1][1] = d
            else:
                groups.append([d, d])
        for low, high in groups:
            begin = max(0, low - band)
            part = text[begin:high + len(template) + band]
            m, a, b = align(template, part, low - begin - band, high - begin + band)
            if m and 100 * m >= COVERAGE * len(template):
                found.append((begin + a, begin + b, t, m))
    found.sort(key=lambda x: (-x[3], -x[3] / len(index.words[x[2]]), x[2], x[0]))
    kept: list[tuple] = []  # by place; they don't overlap, so a span's neighbours decide
    for span in found:
        at = bisect_left(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or kept[at][0] >= span[1]):
            kept.insert(at, span)
    return kept


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = Index()
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("n_matched", pa.int64()), ("coverage", pa.float64())]))
    for batch in batches:
        for i, j, texts in text_slices(batch.column("_text")):
            words, h = split(texts)
            grams, at = windows(h, words.doc, K)
            hit, key = index.look(grams)
            found: list[list] = [[] for _ in range(j - i)]
            of = words.doc[at[hit]]
            for d in np.unique(of).tolist():
                own = of == d
                first = int(words.first[d])
                spans = scan(h[first:int(words.first[d + 1])].tolist(),
                             list(zip((at[hit[own]] - first).tolist(), key[own].tolist(), strict=True)),
                             index)
                if not spans:
                    continue
                raw = words.raw[words.off[d]:words.off[d + 1]]
                points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                byte = lambda x, d=d: int(x - words.off[d])
                found[d] = [{
                    "license": index.names[t],
                    "start": int(points[byte(words.start[first + a])]),
                    "end": int(points[byte(words.end[first + b - 1])]),
                    "n_matched": m, "coverage": m / len(index.words[t])} for a, b, t, m in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(i, j - i), pa.array(found, kind)], ["_id", "spans"])


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and spans: array of (license, start, end, n_matched, coverage),
    in order; code points, end exclusive."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = (f"_id {rows.schema['_id'].dataType.simpleString()}, spans array<struct<license: string, "
              "start: bigint, end: bigint, n_matched: bigint, coverage: double>>")
    return rows.mapInArrow(_run, schema).withColumnRenamed("_id", id_col)


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """License spans of all ``documents``."""
    rows = license_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["license"]))), ",")
        .alias("licenses"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))
        .alias("coverage"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["license"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))
