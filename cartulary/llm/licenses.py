"""License scans: winnowed fingerprints in an inverted index pick candidates, banded alignment reports coverage and spans.

The templates are a fixed, small list; their index travels with the tasks.
Each text is hashed whole, winnowed (of every ``WINDOW`` neighbouring runs of
``RUN`` words the smallest hash is kept, so a shared passage of
``RUN + WINDOW - 1`` words always shares a fingerprint), and looked up.  Where hits
of a template lie close together and are enough of its fingerprints, the template
is aligned with the words around, in the band of diagonals that its hits span and
as much again to either side: a match counts 4, a mismatch -2, a word left out of
either -1, so an inserted paragraph costs a quarter of its words.  A place is
reported if the matched words are ``least`` of the template's; its words are then
masked and the search goes on, so copies side by side are reported each.  Of
places that overlap, that whose template explains most (matched less missing
words) stays: a BSD-2-Clause text isn't also a BSD-3-Clause one.  No shuffle;
each document is independent.

Defined results: null and empty texts have no match; several places of one
template in a text are reported each; repeated rows are reported each; texts of
any length are whole, with alignments bounded by a template's length and hits
around it; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.alignment import align
from cartulary.llm.wordhash import NOT_WORD, Words, spans

RUN, WINDOW = 3, 2
LEAST_COVERAGE = 0.7
#: One in so many of a template's fingerprints must be near a place (one, for short templates) before it is aligned.
HIT_SHARE = 10
MATCH, MISMATCH, GAP = 4, -2, -1

WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR"
    " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH"
    " THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions"
    " are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution."
)
BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission."
)
BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,"
    " BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED"
    " AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT"
    " OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
GNU_GRANT = (
    "free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either"
    " version 3 of the License, or (at your option) any later version."
)
GNU_HOPE = (
    " is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
    " FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
)

#: Notices, file headers and whole texts of common licenses.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
        " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        ' writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,'
        " either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": "This program is " + GNU_GRANT.format("General Public License") + " This program" + GNU_HOPE.format("General Public License"),
    "LGPL-3.0-header": "This library is " + GNU_GRANT.format("Lesser General Public License") + " This library" + GNU_HOPE.format("Lesser General Public License"),
    "AGPL-3.0-header": "This program is " + GNU_GRANT.format("Affero General Public License") + " This program" + GNU_HOPE.format("Affero General Public License"),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,'
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. " + WARRANTY
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that"
        " the above copyright notice and this permission notice appear in all copies."
        ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES'
        " OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR"
        " ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
        " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": BSD_OPENING + BSD_DISCLAIMER,
    "BSD-3-Clause": BSD_OPENING + BSD_THIRD + BSD_DISCLAIMER,
}

#: What a masked word's hash becomes; no word of a template has it.
MASKED = np.uint64(0)

MATCHES = "doc_id bigint, license string, coverage double, matched_words bigint, template_words bigint, start_char bigint, end_char bigint"


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the winnowed runs of each text, in order; texts with fewer runs than a window keep their smallest."""
    h, at = words.grams(RUN)
    if not len(h):
        return h, at
    keep = np.zeros(len(h), dtype=bool)
    text = words.text[at]
    if len(h) >= WINDOW:
        windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
        inside = text[: len(h) - WINDOW + 1] == text[WINDOW - 1 :]
        least = WINDOW - 1 - windows[:, ::-1].argmin(axis=1)
        keep[(np.arange(len(windows)) + least)[inside]] = True
    counts = np.bincount(text)
    keep |= counts[text] < WINDOW
    return h[keep], at[keep]


def places_of(body: np.ndarray, text: np.ndarray, hits: np.ndarray, need: int, least: float) -> list[tuple[int, int, int]]:
    """(matched words, first, last word in ``text``) of the places of a template.

    ``hits`` has (place in the text, place in the template, fingerprint) of each hit, in order; matched words
    are masked in a copy of ``text``, which a caller never sees.
    """
    n, out, free = len(body), [], None
    alone = np.zeros(len(text) if len(hits) else 0, dtype=bool)
    k = 0
    while k < len(hits):
        p = int(hits[k, 0])
        begin, end = p - 2 * n, p + 5 * n  # an alignment of more words than that scores nothing
        while not alone[p]:
            near = hits[k : np.searchsorted(hits[:, 0], end)]
            near = near[~alone[near[:, 0]]]
            if len(np.unique(near[:, 2])) < need:
                break
            if free is None:
                free = text.copy()
            first, last = max(0, begin), min(len(text), end)
            shifts = near[:, 0] - near[:, 1] - first
            spread = int(shifts.max() - shifts.min()) + n
            same, i, j = align(body, free[first:last], int(shifts.min()) - spread, int(shifts.max()) + spread, MATCH, MISMATCH, GAP)[1:]
            if same and first + j == last - 1 and last < len(text):  # may go on behind the words looked at
                end += n
                continue
            if same < least * n:
                break
            out.append((same, first + i, first + j))
            free[first + i : first + j + 1] = MASKED
            alone[first + i : first + j + 1] = True
        # a copy that begins soon behind p would have been in the words looked at
        k = int(np.searchsorted(hits[:, 0], p + 1 if alone[p] else p + max(1, n // 2)))
    return out


def settled(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of (template, its words, matched words, first, last), those that overlap no better one."""
    kept: list[tuple[int, int, int, int, int]] = []
    for one in sorted(found, key=lambda f: (f[1] - 2 * f[2], f[3], f[0])):
        if all(one[4] < x[3] or one[3] > x[4] for x in kept):
            kept.append(one)
    return sorted(kept, key=lambda f: (f[3], f[0]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """A row for each place where a document covers ``least`` of a template's words (columns of ``MATCHES``)."""
    templates = TEMPLATES if templates is None else templates
    names = list(templates)
    told = Words([templates[n].lower().encode() for n in names], NOT_WORD)
    bodies = [told.hash[told.bounds[k] : told.bounds[k + 1]] for k in range(len(names))]
    prints, at = fingerprints(told)
    order = np.argsort(prints, kind="stable")
    prints, at = prints[order], at[order]
    owner, place = told.text[at], at - told.bounds[told.text[at]]
    needs = [max(1, len(np.unique(prints[owner == k])) // HIT_SHARE) for k in range(len(names))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.columns
            for a, z in spans(column):
                texts = [t.encode("utf-8", "surrogatepass").lower() for t in column[a:z].to_pylist()]
                words = Words(texts, NOT_WORD)
                h, first = fingerprints(words)
                lo, hi = np.searchsorted(prints, h, side="left"), np.searchsorted(prints, h, side="right")
                hit = np.flatnonzero(hi > lo)
                times = (hi - lo)[hit]
                k, e = np.repeat(hit, times), np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[hit], times)
                t = words.text[first[k]]
                hits = np.stack([t, owner[e], first[k] - words.bounds[t], place[e], prints[e].view(np.int64)], axis=1)
                hits = hits[np.lexsort((hits[:, 3], hits[:, 2], hits[:, 1], hits[:, 0]))]
                cut = np.flatnonzero((np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 0)) + 1
                found: dict[int, list] = {}
                for some in np.split(hits, cut) if len(hits) else ():
                    text, k = int(some[0, 0]), int(some[0, 1])
                    body = words.hash[words.bounds[text] : words.bounds[text + 1]]
                    found.setdefault(text, []).extend((k, len(bodies[k]), *x) for x in places_of(bodies[k], body, some[:, 2:], needs[k], least))
                # characters before each byte
                chars = np.concatenate([[0], np.cumsum((words.bytes & 0xC0) != 0x80)]) if found else None
                out = []
                for text, places in found.items():
                    for k, n, same, i, j in settled(places):
                        w, start = int(words.bounds[text]), int(words.text_start[text])
                        begin, end = (int(chars[p] - chars[start]) for p in (words.start[w + i], words.end[w + j]))
                        out.append((ids[a + text].as_py(), names[k], same / n, same, n, begin, end))
                if out:
                    kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in MATCHES.split(", ")])

    told_docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return told_docs.mapInArrow(scan, MATCHES)
