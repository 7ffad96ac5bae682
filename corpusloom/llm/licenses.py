"""License scans: winnowed fingerprints, an inverted index, banded alignment.

Templates and texts are lower-cased alphanumeric words. Hashes of ``GRAM`` words of a template are winnowed: of any ``SPAN``
neighbouring ones the least (the last of equals) is kept; a template of fewer than ``SMALL`` words keeps all its pairs of words. They
form an inverted index to (template, place), in which all grams and pairs of a text are looked up.

A text's hits on a template are gathered into pieces by diagonal, wherever they lie, and each piece is a candidate. One hit is enough, and
for a small template two, as a notice that keeps ``COVERAGE`` of N words keeps (2 COVERAGE - 1) N - 1 pairs of neighbours at least. A longer notice fails
only if none of its kept grams is intact. A piece is aligned in a band, all pieces of a batch of texts at once: its part of the template with the text around it, and,
if enough of the template's words occur near their places, the whole template. Parts are chained in the order of text and template, and each word by which a chain
changes its diagonal counts against it, half as much as a matched one counts for it; a whole template is a match as it is. So text that is inserted, left out or cut off
costs its own words, and no piece is aligned or chained otherwise for what else the text holds. A match is reported from ``COVERAGE`` of the
template on, with its coverage and span; a template of fewer than ``SHORT`` words must be there word for word, as one word tells it from
another. Of overlapping matches the one with more matched words stays, of equals the one with more coverage.
"""

from __future__ import annotations

import re

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .textkit import SpanHash, map_rows

GRAM = 3
SPAN = 3
BAND = 8
GAP = 60
COVERAGE = 0.6
SHORT = 20
SMALL = 60
_WORD = re.compile(r"[A-Za-z0-9]+")

# Public license notices.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions"
    " are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT"
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0-short": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "mit-short": "Released under the MIT License.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "bsd-short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
    " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
    " is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be"
    " included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND,"
    " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
    " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
    " IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
    " provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND"
    " THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
    " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF"
    " OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause": _BSD + _BSD_END,
    "bsd-3-clause": _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission." + _BSD_END,
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
    " damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including"
    " commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this"
    " software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a"
    " product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must"
    " be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or"
    " altered from any source distribution.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying"
    " documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the"
    " Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so,"
    " all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant,"
    " this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all"
    " derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code"
    " generated by a source language processor.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
    " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable"
    " law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
    " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
    " limitations under the License.",
    "gpl-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later"
    " version.",
    "gpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
    " version.",
    "lgpl-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
    " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
    " any later version.",
    "lgpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
    " version.",
    "agpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
    " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
    " version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
    " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is"
    " available at https://www.eclipse.org/legal/epl-2.0/",
    "cc0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this"
    " software to the public domain worldwide. This software is distributed without any warranty.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
    " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial"
    " or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate"
    " any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at"
    " large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in"
    " perpetuity of all present and future rights to this software under copyright law.",
}


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-cased words and their character spans in ``text`` (ASCII letters and digits only)."""
    found = list(_WORD.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


def codes_of(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def winnow(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the kept fingerprints of word codes; all words as one gram if there are fewer."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spans = SpanHash(codes | np.uint64(1))
    size = min(GRAM, n)
    at = np.arange(n - size + 1)
    h = spans.spans(at, at + size)
    if len(h) <= SPAN:
        least = len(h) - 1 - int(h[::-1].argmin())
        return h[least : least + 1], np.array([least])
    view = np.lib.stride_tricks.sliding_window_view(h[::-1], SPAN)
    keep = np.unique(len(h) - 1 - (view.argmin(axis=1) + np.arange(len(view))))
    return h[keep], keep


def align(parts: list[tuple[np.ndarray, np.ndarray, int]], band: int = BAND) -> list[tuple[int, int, int, int, int]]:
    """(matched words, first, end of them in the text, first, end of them in the template) of the best banded alignment of each (template words, text, shift): the whole
    of the template words with text[shift:]. Matches score 1, a gap or a differing word -0.5 each; the text's ends are free."""
    out: list[tuple[int, int, int, int, int]] = [(0, 0, 0, 0, 0)] * len(parts)
    order = sorted(range(len(parts)), key=lambda i: len(parts[i][0]))
    width = 2 * band + 1
    j = np.arange(width)
    for lo in range(0, len(order), 256):  # pieces of like length together
        own = order[lo : lo + 256]
        most = max(len(parts[i][0]) for i in own)
        words = np.zeros((len(own), most), dtype=np.uint64)
        around = np.zeros((len(own), most + width), dtype=np.uint64)
        there = np.zeros((len(own), most + width), dtype=bool)
        for r, i in enumerate(own):
            template, text, shift = parts[i]
            words[r, : len(template)] = template
            a, b = max(0, shift - band), min(len(text), shift - band + most + width)
            if b > a:
                around[r, a - shift + band : b - shift + band] = text[a:b]
                there[r, a - shift + band : b - shift + band] = True
        base = np.array([parts[i][2] - band for i in own])[:, None]
        length = np.array([len(parts[i][0]) for i in own])
        # state j after i template words: text up to base + i + j; its score, and what it has matched, from where to where
        score = np.zeros((len(own), width))
        state = np.zeros((5, len(own), width), dtype=np.int64)
        final_score, final = score, state
        for i in range(most + 1):
            done = (length == i)[:, None]
            if done.any():
                final_score, final = np.where(done, score, final_score), np.where(done, state, final)
            if i == most:
                break
            same = (around[:, i : i + width] == words[:, i : i + 1]) & there[:, i : i + width]
            at = base + i + j
            begun, here = same & (state[0] == 0), np.broadcast_to(at, same.shape)
            taken = np.stack([
                state[0] + same, np.where(begun, here, state[1]), np.where(same, here + 1, state[2]),
                np.where(begun, i, state[3]), np.where(same, i + 1, state[4]),
            ])
            took = np.where(there[:, i : i + width], score + np.where(same, 1.0, -0.5), -1e9)
            skip = np.concatenate([score[:, 1:], np.full((len(own), 1), -1e9)], axis=1) - 0.5  # a word of the template is missing
            state = np.where(skip > took, np.concatenate([state[:, :, 1:], state[:, :, -1:]], axis=2), taken)
            lifted = np.maximum(took, skip) + 0.5 * j  # words of the text are extra: from the best state to the left
            best = np.maximum.accumulate(lifted, axis=1)
            source = np.maximum.accumulate(np.where(lifted == best, j, 0), axis=1)
            score = best - 0.5 * j
            state = np.take_along_axis(state, source[None], axis=2)
        pick = np.lexsort((final_score.T, final[0].T), axis=0)[-1] if len(own) else []
        for r, i in enumerate(own):
            out[i] = tuple(final[:, r, pick[r]].tolist())
    return out


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    at = np.arange(max(0, len(codes) - size + 1))
    return SpanHash(codes | np.uint64(1)).spans(at, at + size)


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [codes_of(words_of(t)[0]) for t in templates.values()]
        table: list[tuple[int, int, int]] = []
        for k, w in enumerate(self.words):
            if len(w) < SMALL:
                hashes = grams(w, min(2, len(w)))
                places = np.arange(len(hashes))
            else:
                hashes, places = winnow(w)
            table += [(h, k, at) for h, at in zip(hashes.tolist(), places.tolist(), strict=True)]
        table.sort()
        self.hashes = np.array([h for h, _, _ in table], dtype=np.uint64)
        self.kinds = np.array([k for _, k, _ in table], dtype=np.int64)
        self.places = np.array([at for _, _, at in table], dtype=np.int64)
        #: Sizes of the indexed grams.
        self.sizes = sorted({min(2, len(w)) if len(w) < SMALL else GRAM for w in self.words if len(w)})

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, place in it, place in the text) of every gram of the text that a template's index has."""
        out = []
        for size in self.sizes:
            hashes = grams(codes, size)
            lo = np.searchsorted(self.hashes, hashes, "left")
            at = np.flatnonzero(self.hashes[np.minimum(lo, len(self.hashes) - 1)] == hashes) if len(hashes) else lo
            lo, hi = lo[at], np.searchsorted(self.hashes, hashes[at], "right")
            n = hi - lo
            entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((self.kinds[entry], self.places[entry], np.repeat(at, n)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def pieces(self, codes: np.ndarray, coverage: float = COVERAGE) -> Iterator[tuple[int, int, int, int]]:
        """(template, first and end word of the template's part, shift) of each piece of each candidate."""
        kinds, places, at = self.hits(codes)
        for k in np.unique(kinds).tolist():
            own = np.flatnonzero(kinds == k)
            size = len(self.words[k])
            least = 1 if size >= SMALL or coverage < COVERAGE else min(2, size - 1) if size > 1 else 1
            order = np.lexsort((places[own], at[own] - places[own]))
            p, shift = places[own][order], (at[own] - places[own])[order]
            begin = 0
            for i in range(1, len(p) + 1):
                if i == len(p) or shift[i] - shift[begin] > BAND // 2:
                    if i - begin >= least:
                        yield k, int(p[begin:i].min()), min(size, int(p[begin:i].max()) + GRAM), int(shift[begin])
                    begin = i

    def possible(self, k: int, codes: np.ndarray, shift: int) -> int:
        """Words of a template that occur in the text within the band around their places: no alignment there matches more."""
        size = len(self.words[k])
        around = np.zeros(size + 2 * BAND, dtype=np.uint64)
        lo, hi = max(0, shift - BAND), min(len(codes), shift + size + BAND)
        if hi > lo:
            around[lo - shift + BAND : hi - shift + BAND] = codes[lo:hi]
        view = np.lib.stride_tricks.sliding_window_view(around, 2 * BAND + 1)
        return int((view == self.words[k][:, None]).any(axis=1).sum())

    def scan_all(self, texts: list[str | None], coverage: float = COVERAGE) -> list[list[tuple[str, float, int, int, int, int, int]]]:
        """For each text (license, coverage, matched, first word, end word, first char, end char) of each match, in text order."""
        spans, parts, which = [], [], []
        for i, text in enumerate(texts):
            words, where = words_of(text or "")
            spans.append(where)
            if not words:
                continue
            codes = codes_of(words)
            for k, a, b, shift in self.pieces(codes, coverage):
                # a piece's part reaches over the words beside its hits
                size, a, b = len(self.words[k]), max(0, a - GRAM - SPAN), min(len(self.words[k]), b + GRAM + SPAN)
                parts.append((self.words[k][a:b], codes, shift + a))
                which.append((i, k, a, True))
                if b - a < size and self.possible(k, codes, shift) >= coverage * size:
                    parts.append((self.words[k], codes, shift))
                    which.append((i, k, 0, False))
        chains: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}
        found: list[list[tuple]] = [[] for _ in texts]

        def match(i: int, k: int, matched: int, first: int, end: int) -> None:
            size = len(self.words[k])
            if matched == size == end - first if size < SHORT else matched >= coverage * size:
                found[i].append((-matched, -matched / size, first, end, self.names[k]))

        for (i, k, a, part), (matched, first, end, low, high) in zip(which, align(parts), strict=True):
            if matched and part:
                chains.setdefault((i, k), []).append((first, end, a + low, a + high, matched))
            elif matched:
                match(i, k, matched, first, end)
        for (i, k), pieces in chains.items():
            for chain in _chains(pieces):
                match(i, k, *chain)
        out: list[list[tuple]] = []
        for own, where in zip(found, spans, strict=True):
            kept: list[tuple] = []  # in text order, none overlaps another
            for m, share, a, b, name in sorted(own):
                at = bisect_left(kept, a, key=lambda x: x[3])
                if (at == 0 or kept[at - 1][4] <= a) and (at == len(kept) or kept[at][3] >= b):
                    kept.insert(at, (name, -share, -m, a, b, where[a][0], where[b - 1][1]))
            out.append(kept)
        return out

    def scan(self, text: str | None, coverage: float = COVERAGE) -> list[tuple[str, float, int, int, int, int, int]]:
        return self.scan_all([text], coverage)[0]


def _chains(pieces: list[tuple[int, int, int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(matched, first, end) of chains of pieces (first, end, template first, template end, matched) that advance in text and
    template alike, at most ``GAP`` words of the text apart; best ones first, no piece in two. An overlap counts once, and a change of
    diagonal counts against a chain by half its words, so that no chain goes over to another copy for a notice's damaged part."""
    pieces = sorted(pieces)
    best: list[tuple[float, int, int]] = []  # score, matched, piece before
    at = 0
    for i, (first, end, a, b, matched) in enumerate(pieces):
        held = (float(matched), matched, -1)
        while at < i and pieces[at][1] + GAP < first:
            at += 1
        for x in range(at, i):
            _, pe, pa, pb, _ = pieces[x]
            if pa < a and pb < b and pe < end and first - pe <= GAP:
                new = matched - max(0, pb - a, pe - first)
                score = best[x][0] + new - 0.5 * abs((first - a) - (pe - pb))
                if score > held[0]:
                    held = (score, best[x][1] + new, x)
        best.append(held)
    used: set[int] = set()
    for i in sorted(range(len(pieces)), key=lambda i: (-best[i][0], i)):
        chain = [i]
        while chain[-1] not in used and best[chain[-1]][2] >= 0:
            chain.append(best[chain[-1]][2])
        if used.isdisjoint(chain):
            yield best[i][1], pieces[chain[-1]][0], pieces[i][1]
        used.update(chain)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, matched_words, first_word, end_word, first_char, end_char), one row a match.

    Whole texts are scanned; null and empty texts have no match; repeated rows repeat their matches; null ids pass;
    other columns are not read; no rows give no rows. The index of the templates is part of the task (its size is theirs).
    """
    index = Index(TEMPLATES if templates is None else templates)
    schema = (
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, license string, coverage double, matched_words long,"
        " first_word long, end_word long, first_char long, end_char long"
    )

    def rows(part: list[tuple]) -> list[tuple]:
        ids, texts = zip(*part, strict=True) if part else ((), ())
        return [(i, *m) for i, found in zip(ids, index.scan_all(list(texts), coverage), strict=True) for m in found]

    return map_rows(docs, [id_col, text_col], schema, rows)
