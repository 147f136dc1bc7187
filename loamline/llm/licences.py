"""Licence scans: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment reports spans."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, map_texts

_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Public licence notices and texts, as their publishers word them.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "bsd-2-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsd-3-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


@dataclass(frozen=True)
class Settings:
    """Fingerprints are hashes of k words, the least of each `window` in a row: any k + window - 1 words in common share
    one. band: how many words the alignment may drift (under half the template's words). coverage: the share of a template's words
    that a whole copy matches; less is reported as partial from `partial_words` matched words on."""

    k: int = 3
    window: int = 3
    band: int = 12
    coverage: float = 0.8
    partial_words: int = 20


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower())


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    n = len(hashes) - k + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(k if n > 0 else 0):
        out = (out ^ hashes[i : i + n]) * _MIX
        out ^= out >> np.uint64(31)
    return out


def winnow(values: np.ndarray, window: int) -> np.ndarray:
    """Places of the winnowed values: the least of each window (the last one of equals); of all, if they are fewer."""
    if len(values) <= window:
        return np.array([len(values) - 1 - int(values[::-1].argmin())]) if len(values) else np.zeros(0, int)
    views = np.lib.stride_tricks.sliding_window_view(values, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(1))


@dataclass(frozen=True)
class Index:
    """The templates' words and the inverted index of their fingerprints: sorted keys, and (template, place) of each."""

    names: tuple[str, ...]
    words: tuple[np.ndarray, ...]
    keys: np.ndarray
    postings: tuple[tuple[int, int], ...]
    settings: Settings


def build_index(templates: Mapping[str, str] = TEMPLATES, settings: Settings = Settings()) -> Index:
    """A template needs k + window - 1 words at least, so that it cannot be missed."""
    entries, words = [], []
    for i, (name, text) in enumerate(templates.items()):
        hashes = np.array([_hash(w) for w in _WORD.findall(text)], np.uint64)
        if len(hashes) < settings.k + settings.window - 1:
            raise ValueError(f"template {name} is too short")
        words.append(hashes)
        g = grams(hashes, settings.k)
        entries += [(int(g[p]), i, int(p)) for p in winnow(g, settings.window)]
    entries.sort()
    return Index(tuple(templates), tuple(words), np.array([e[0] for e in entries], np.uint64), tuple((i, p) for _, i, p in entries), settings)


def align(template: np.ndarray, doc: np.ndarray, band: int) -> tuple[int, int, int]:
    """Matched words, first and last + 1 matched word of the piece, by matched_pairs(); zeros without a match."""
    pairs = matched_pairs(template, doc, band)
    return (len(pairs), pairs[0][1], pairs[-1][1] + 1) if pairs else (0, 0, 0)


def matched_pairs(template: np.ndarray, doc: np.ndarray, band: int) -> list[tuple[int, int]]:
    """Banded local alignment (match 2, other -1) of a template with a piece of a document that starts `band` words before
    the diagonal: the places (template, piece) of the words that match, in order. Of paths with equal
    scores the one with more matches wins: a cell holds the score times `unit`, plus the matches."""
    n, m, width = len(template), len(doc), 2 * band + 1
    unit = 1 << 20
    low = -(1 << 50)
    score = [0] * width
    trace: list[list[int]] = []
    best = (0, -1, -1)
    for i in range(n):
        word, row, steps = template[i], [low] * width, [0] * width
        for c in range(width):
            j = i + c  # the doc's word in this cell of the band
            if j >= m:
                break
            same = doc[j] == word
            value, step = (score[c] if i else 0) + (2 * unit + 1 if same else -unit), 1  # diagonal
            if i and c + 1 < width and score[c + 1] - unit > value:
                value, step = score[c + 1] - unit, 2  # template word left out
            if c and row[c - 1] - unit > value:
                value, step = row[c - 1] - unit, 3  # document word left out
            if value <= 0:
                value, step = 0, 0
            row[c], steps[c] = value, step
            if value > best[0]:
                best = (value, i, c)
        trace.append(steps)
        score = row
    value, i, c = best
    pairs: list[tuple[int, int]] = []
    while value > 0 and i >= 0 and 0 <= c < width and trace[i][c]:
        step = trace[i][c]
        if step == 1:
            if doc[i + c] == template[i]:
                pairs.append((i, i + c))
            i -= 1
        elif step == 2:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return pairs[::-1]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in both places."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    pairs = sorted(pairs, key=lambda p: (p[0], -p[1]))
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(tails, j)
        before[k] = at[n - 1] if n else -1
        tails[n:n + 1], at[n:n + 1] = [j], [k]
    out, k = [], at[-1]
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def chains(pieces: list[list[tuple[int, int]]], reach: int) -> list[list[tuple[int, int]]]:
    """The pairs of each copy of a template: aligned pieces that follow each other in template and text belong to one copy, with
    up to `reach` other words between them. Of pieces that share half of their text the one with more words stays."""
    found: list[list[tuple[int, int]]] = []
    for piece in sorted(pieces, key=lambda p: (p[0][1], -len(p))):
        if found:
            shared = min(found[-1][-1][1], piece[-1][1]) + 1 - piece[0][1]
            if 2 * shared > min(p[-1][1] + 1 - p[0][1] for p in (found[-1], piece)):
                if len(piece) > len(found[-1]):
                    found[-1] = piece
                continue
        found.append(piece)
    total, before = [len(p) for p in found], [-1] * len(found)
    longest = max((p[-1][1] - p[0][1] for p in found), default=0)
    for i, p in enumerate(found):
        for j in range(i - 1, -1, -1):
            q = found[j]
            if p[0][1] - q[0][1] > longest + reach:
                break
            if p[0][1] - q[-1][1] - 1 > reach or any(not (q[0][x] < p[0][x] and q[-1][x] < p[-1][x]) for x in (0, 1)):
                continue
            over = max(0, *(q[-1][x] + 1 - p[0][x] for x in (0, 1)))
            if 2 * over <= min(len(p), len(q)) and total[j] + len(p) - over > total[i]:
                total[i], before[i] = total[j] + len(p) - over, j
    out, used = [], set()
    for i in sorted(range(len(found)), key=lambda i: (-total[i], i)):
        chain = []
        while i >= 0 and i not in used:
            used.add(i)
            chain += found[i]
            i = before[i]
        if chain:
            out.append(_rising(chain))
    return out


def scan(text: str | None, index: Index, cache: BoundedCache) -> list[tuple]:
    """(template, matched words, template words, coverage, first character, last + 1, partial) of every match in a whole text, in order."""
    s = index.settings
    found = _WORD.findall(text or "")
    hashes = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    cache.trim()
    g = grams(hashes, s.k)
    places = winnow(g, s.window)
    if not len(places) or not len(index.keys):
        return []
    values = g[places]
    lo, hi = np.searchsorted(index.keys, values, "left"), np.searchsorted(index.keys, values, "right")
    anchors: dict[int, list[tuple[int, int]]] = {}
    for at in np.flatnonzero(hi > lo):
        for t, p in index.postings[lo[at] : hi[at]]:
            anchors.setdefault(t, []).append((int(places[at]) - p, p))
    kept = []
    for t, diagonals in anchors.items():
        diagonals.sort()
        template, pieces = index.words[t].tolist(), []
        band = min(s.band, (len(template) - 1) // 2)  # so that one copy after another is another diagonal
        groups: list[tuple[int, list[int]]] = []
        for d, p in diagonals:
            if not groups or d - groups[-1][0] > band:
                groups.append((d, []))
            groups[-1][1].append(p)  # within the band of the alignment
        for d, starts in groups:
            parts = [(0, len(template))]
            while parts:  # what lies before and after the best piece may hold others
                low, high = parts.pop()
                if not any(low <= p and p + s.k <= high for p in starts):
                    continue
                begin = d + low - band  # the piece starts a band before the diagonal; before the text there are words of no kind
                piece = hashes[max(0, begin) : max(0, d + high + band)]
                if begin < 0:
                    piece = np.concatenate([np.zeros(-begin, np.uint64), piece])
                pairs = [(low + i, begin + j) for i, j in matched_pairs(template[low:high], piece.tolist(), band)]
                if pairs:
                    pieces.append(pairs)
                    parts += [(low, pairs[0][0]), (pairs[-1][0] + 1, high)]
        for pairs in chains(pieces, len(template)):
            whole = len(pairs) >= s.coverage * len(template)
            if whole or len(pairs) >= s.partial_words:
                kept.append((t, len(pairs), pairs[0][1], pairs[-1][1] + 1, not whole))
    if not kept:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    kept.sort(key=lambda r: (r[2], r[0]))
    return [(index.names[t], m, len(index.words[t]), m / len(index.words[t]), spans[first][0], spans[end - 1][1], partial) for t, m, first, end, partial in kept]


@lru_cache(1)
def _word_cache() -> BoundedCache:
    return BoundedCache(_hash)


MATCHES = T.ArrayType(T.StructType([
    T.StructField("template", T.StringType()), T.StructField("matched_words", T.IntegerType()), T.StructField("template_words", T.IntegerType()),
    T.StructField("coverage", T.DoubleType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("partial", T.BooleanType()),
]))


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, settings: Settings = Settings(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for every match of a template in a row of docs: the kept columns and template, matched_words,
    template_words, coverage, start and end (characters of the text, end exclusive), and partial: coverage below that of a whole copy.

    The index is small and fixed, so it travels with the task. Null and empty texts, and texts without matches, give no
    rows; repeated rows give their matches each; a template that occurs twice gives two rows. Kept columns (all by default) named as a
    new one give way.
    """
    index = build_index(templates, settings)
    new = [f.name for f in MATCHES.elementType.fields]

    def make():
        cache = _word_cache()
        names = new

        def run(texts):
            return {"__matches": [[dict(zip(names, m)) for m in scan(t, index, cache)] for t in texts]}

        return run

    stay = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    found = map_texts(docs, make, [("__matches", MATCHES)], text, stay).where(F.size("__matches") > 0)
    return found.select(*[F.col(f"`{c}`") for c in stay], F.inline("__matches"))
