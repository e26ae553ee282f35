"""License scans: which license notices a document holds, in whole or in part.

Documents and templates are cut into windows of 8 words (4 shingles of 5 words) that overlap by all but one word;
a shorter template is one window. Each window has 4 minima, each a band of its own, so two windows of similarity j meet
with probability 1 - (1 - j)^4 (``meeting``): 0.97 where 3 of 4 shingles are shared, 0.80 where 2 are. A template of n shingles has n - 3 windows, and one meeting
is enough; a passage that keeps 0.8 of a template's shingles keeps long runs of them, so it is missed only if all its windows miss at once.
Tests measure this over passages at 0.8 to 0.9 of all templates. A meeting places the template in the document; what it claims is
then verified: of each of the template's shingles the occurrence nearest to its place there, a quarter of the template away at most, over all of its shingles, and
the stretch that they take is a quarter longer than the template at most. So a phrase that a neighbouring notice shares does not stretch the claim. Claims are settled shingle by shingle: the one that explains most
takes its shingles (then the one of highest containment, the tightest, the first in the text, the first template), and a later one stays if what is left for it still reaches the
containment; so a notice with a third clause is not taken for one without, nor the other way round, and notices that follow each other are all found.

Tags ("SPDX-License-Identifier: MIT") are too short for shingles; they are matched word by word, for every identifier that templates have.

Templates are a table of bounded size (checked; an error beyond ``MAX_WINDOWS`` windows), held by every worker. A notice that several licenses share word by word has the name
of the family ("BSD") as long as nothing that tells them apart is there.

Defined results: null and empty texts and those of fewer than 5 words have no match; a null doc_id is carried through; repeated rows are judged
each; templates of fewer than 5 words match nothing but tags with their identifiers; an empty table gives no rows; very long texts are scanned whole, one at a time; other columns, also of
clashing names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces, table
from loomgraph.llm.words import ALNUM, U64, Words, grams, mix, stream, words

SHINGLE, SPAN, BANDS, AT_LEAST = 5, 4, 4, 0.8
MAX_WINDOWS = 1_000_000

#: Parts that notices share, and license identifiers with the notices that name them (fixed values, from the public license texts).
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_KEEP = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_END = ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'
_GNU = " under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_KEEP + _MIT_END),
    ("MIT-0", _MIT + "." + _MIT_END),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies." + _ISC_END),
    ("0BSD", _ISC + "." + _ISC_END),
    ("BSD", _BSD + _BSD_1),
    ("BSD-2-Clause", _BSD + _BSD_1 + _BSD_2),
    ("BSD-2-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_END),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_3),
    ("BSD-3-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_END),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation."),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it" + _GNU.format("General Public License", "3")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it" + _GNU.format("General Public License", "2")),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it" + _GNU.format("Lesser General Public License", "3")),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it" + _GNU.format("Lesser General Public License", "2.1")),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it" + _GNU.format("Affero General Public License", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software."),
    ("Proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
]
_BANDS = stream(BANDS, 404)


def meeting(similarity: float) -> float:
    """Probability that two windows of a similarity share a band."""
    return 1 - (1 - similarity) ** BANDS


def _minima(g: np.ndarray, ok: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each band: the least hash of every n shingles in a row, and the windows that lie within one text."""
    if len(g) < n:
        return
    m = len(g) - n + 1
    fine = ok[:m].copy()
    for j in range(1, n):
        fine &= ok[j : m + j]
    # Shingles of one text are followed by SHINGLE - 1 places where none begins, so whole runs of ok never cross texts.
    for band in range(BANDS):
        own = mix(g ^ _BANDS[band])
        least = own[:m].copy()
        for j in range(1, n):
            np.minimum(least, own[j : m + j], out=least)
        yield band, least, fine


class Templates:
    def __init__(self, rows: list[tuple[str, str]]):
        self.names = [r[0] for r in rows]
        w = words(pa.array([r[1] or "" for r in rows], pa.string()), ALNUM)
        self.size = np.diff(w.first)
        g, ok = grams(w, SHINGLE)
        self.sets = [np.unique(g[a : b - SHINGLE + 1]) if b - a >= SHINGLE else np.zeros(0, U64) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.places = [{} for _ in rows]  # of each shingle in its template
        for t, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
            for j, h in enumerate(g[a : max(a, b - SHINGLE + 1)].tolist()):
                self.places[t].setdefault(h, []).append(j)
        self.tags = _tags(sorted(set(self.names)))
        self.index = {}
        for n in range(1, SPAN + 1):
            entries = set()
            for band, least, fine in _minima(g, ok, n):
                at = np.flatnonzero(fine)
                whole = np.minimum(self.size[w.doc[at]] - SHINGLE + 1, SPAN) == n
                at = at[whole]
                entries |= {(band, int(h), int(t), int(p)) for h, t, p in zip(least[at], w.doc[at], at - w.first[w.doc[at]], strict=True)}
            for band in range(BANDS):
                own = sorted(e[1:] for e in entries if e[0] == band)
                if own:
                    key = np.array([e[0] for e in own], U64)
                    seen = np.zeros(1 << 18, bool)
                    seen[(key >> U64(46)).astype(np.int64)] = True
                    self.index[n, band] = key, np.array([e[1] for e in own]), np.array([e[2] for e in own]), seen
        if sum(len(x[0]) for x in self.index.values()) > MAX_WINDOWS:
            raise ValueError("more template windows than a worker may hold")

    def matches(self, col: pa.Array, at_least: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, license, first word, words, containment); no shingle counts for two."""
        w = words(col, ALNUM)
        g, ok = grams(w, SHINGLE)
        found = set()
        for n in sorted({k[0] for k in self.index}):
            for band, least, fine in _minima(g, ok, n):
                if (n, band) not in self.index:
                    continue
                key, template, place, seen = self.index[n, band]
                at = np.flatnonzero(fine & seen[(least >> U64(46)).astype(np.int64)])
                lo, hi = np.searchsorted(key, least[at], "left"), np.searchsorted(key, least[at], "right")
                for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                    for e in range(a, b):
                        found.add((int(w.doc[p]), int(template[e]), p - int(place[e])))
        claims = []
        for row, t, start in sorted(found):
            size, own = int(self.size[t]), self.places[t]
            slack = size // 4 + 1
            first, last = int(w.first[row]), int(w.first[row + 1])
            lo, hi = max(first, start - slack), min(last - SHINGLE + 1, start + size - SHINGLE + 1 + slack)
            near: dict[int, tuple[int, int]] = {}
            for q in (lo + np.flatnonzero(np.isin(g[lo : max(lo, hi)], self.sets[t]))).tolist():
                h = int(g[q])
                away = min(abs(q - start - j) for j in own[h])
                if away <= slack:
                    near[h] = min(near.get(h, (away, q)), (away, q))
            at = sorted(q for _, q in near.values())
            if len(at) >= at_least * len(own) and at and at[-1] - at[0] + SHINGLE <= size + slack:
                claims.append((row, -len(at), -len(at) / len(own), at[-1] - at[0], at[0], t, at))
        taken: set[int] = set()
        for row, *_, t, at in sorted(claims):
            rest = [q for q in at if q not in taken]
            if rest and len(rest) >= at_least * len(self.places[t]):
                taken.update(q for q in range(rest[0], rest[-1] + 1) if int(g[q]) in self.places[t])
                yield row, self.names[t], rest[0] - int(w.first[row]), rest[-1] - rest[0] + SHINGLE, len(rest) / len(self.places[t])
        yield from self.tagged(w)

    def tagged(self, w: Words) -> Iterator[tuple[int, str, int, int, float]]:
        lead, ids = self.tags
        n = len(w.hash) - len(lead)
        at = np.flatnonzero(np.logical_and.reduce([w.hash[j : j + n] == h for j, h in enumerate(lead)])) if n > 0 else []
        for p in (int(x) for x in at):
            rest = w.hash[p + len(lead) : w.first[w.doc[p] + 1]].tolist()  # words of the same text
            fits = [(len(words_), name) for name, words_ in ids if rest[: len(words_)] == words_]
            if fits and p + len(lead) < w.first[w.doc[p] + 1]:
                n_words, name = max(fits)
                yield int(w.doc[p]), name, p - int(w.first[w.doc[p]]), len(lead) + n_words, 1.0


def _tags(names: list[str]) -> tuple[list[int], list[tuple[str, list[int]]]]:
    """Word hashes of the lead of a tag, and of each identifier."""
    w = words(pa.array(["SPDX-License-Identifier", *names]), ALNUM)
    lead, *rest = (w.hash[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True))
    return lead, list(zip(names, rest, strict=True))


def licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, *, at_least: float = AT_LEAST) -> DataFrame:
    """doc_id, matches (license, start word, words, containment; in order of place) of every document."""
    sent = attach(docs.sparkSession).sparkContext.broadcast(Templates(list(templates)))
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in pieces(batches, "text"):
            out: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for row, name, start, n, held in own.matches(b.column("text"), at_least):
                out[row].append({"license": name, "start": start, "words": n, "containment": held})
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([sorted(x, key=lambda m: m["start"]) for x in out], kind)], ["doc_id", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, matches array<struct<license:string,start:long,words:long,containment:double>>")


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return licenses(table(spark, sf_dir, "documents")).select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), F.array_max(F.transform("matches", lambda m: m["containment"])).alias("containment"))
