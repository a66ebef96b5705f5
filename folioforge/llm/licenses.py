"""License scans by conditional compression.

A match may differ from its template in some of the words (``TOLERANCE``), so of
one more parts than words may differ at least one is in the text as it is. Where
a part is, the match lies within as many words as the template has and may
differ in: candidate blocks are the stretches of words that those add up to, and
none that holds a match is missed. Windows of a block are compressed with each
template as a raw dictionary; the template that saves most bytes against
compression without one explains the window best. Places are confirmed in this
order, by counting the word differences exactly. What is confirmed is kept as
soon as no template that has not been looked at could agree in more words, and
places that it covers are not looked at any more: the ranking decides how much
there is to confirm, not what is found.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import count, pairwise
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import ship

#: Wordings of public licenses and of the usual notices that refer to them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit-notice": "Released under the MIT License.",
    "mit-full": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "mit-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-2-clause-full": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-3-clause-full": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "isc-full": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "unlicense-text": 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/',
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
#: Word differences that a match may have, as a part of the template's words.
TOLERANCE = 0.15
WORD = re.compile(r"\w+")
SCHEMA = "doc_id long, license string, start int, end int, bytes_saved int, n_words int, n_different int, is_exact boolean"


def words_of(template: str) -> list[str]:
    return [w.group().lower() for w in WORD.finditer(template)]


def read_templates(folder: str) -> dict[str, str]:
    """Whole licenses from a folder of text files, each by its file's name with ``-body``.

    For ``scan_licenses(docs, TEMPLATES | read_templates(folder))``; they go to the tasks
    with the function. Of links to one file, or files with the same words, the last name stays.
    """
    found = {}
    for path in sorted(Path(folder).iterdir()):
        if path.is_file():
            text = path.read_text("utf-8", "replace")
            found[tuple(words_of(text))] = (path.name, text)
    return {f"{name}-body": text for name, text in found.values()}


def parts_of(words: list[str]) -> list[tuple[int, list[str]]]:
    """(place, words) of the parts of a template: one more than words may differ, so that any match holds one of them unchanged."""
    n = int(TOLERANCE * len(words)) + 1
    cuts = [i * len(words) // n for i in range(n + 1)]
    return [(x, words[x:y]) for x, y in pairwise(cuts)]


def automaton(patterns: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for x in patterns:
        found.add_word(x, x)
    found.make_automaton()
    return found


def matches_by_end(words: np.ndarray, template: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(differences, first) for every last + 1: the stretch of ``words`` that ends there with the fewest word insertions, deletions and changes against the template."""
    n = len(words)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    for t in template:
        down, down_begin = cost + 1, begin
        across = cost[:-1] + (words != t)
        new, new_begin = down.copy(), down_begin.copy()
        better = across < new[1:]
        new[1:][better], new_begin[1:][better] = across[better], begin[:-1][better]
        # A word too many in the text: smallest cost to the left plus the distance.
        flat = new - np.arange(n + 1)
        least = np.minimum.accumulate(flat)
        source = np.maximum.accumulate(np.where(flat == least, np.arange(n + 1), 0))
        cost, begin = least + np.arange(n + 1), new_begin[source]
    return cost, begin


def best_match(words: np.ndarray, template: np.ndarray) -> tuple[int, int, int]:
    """(differences, first, last + 1): the stretch of ``words`` with the fewest differences; the leftmost, then shortest, of equals."""
    cost, begin = matches_by_end(words, template)
    last = int(np.argmin(cost))
    return int(cost[last]), int(begin[last]), last


@dataclass(slots=True)
class Place:
    """Words [first, last) that may hold a match of a template, and the parts of it that are there."""

    name: str
    size: int
    first: int
    last: int
    parts: list[tuple[int, int]]
    saved: int = 0
    gone: bool = False

    def rank(self) -> tuple[int, int, str, int]:
        return -self.saved, -self.size, self.name, self.first

    def without(self, a: int, b: int) -> list[Place]:
        """What remains to either side of [a, b), if a part is there."""
        out = []
        for x, y in ((self.first, min(a, self.last)), (max(b, self.first), self.last)):
            held = [(p, q) for p, q in self.parts if x <= p and q <= y]
            if held:
                out.append(Place(self.name, self.size, x, y, held, self.saved))
        return out


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.words = {n: w for n, t in templates.items() if (w := words_of(t))}
        self.most = max(map(len, self.words.values()), default=0)
        self.allowed = {n: int(TOLERANCE * len(w)) for n, w in self.words.items()}
        self.parts: dict[str, list[tuple[str, int, int]]] = {}
        for n, w in self.words.items():
            for at, part in parts_of(w):
                self.parts.setdefault(f" {' '.join(part)} ", []).append((n, at, len(part)))
        # One word of each part, for texts that hold none of them have no part either. Folding depends on no neighbours.
        self.cues = automaton({max(x.split(), key=lambda w: (len(w), w)).casefold() for x in self.parts})
        self.phrases = automaton(self.parts)
        # The same parameters with and without a dictionary, or the difference would be theirs.
        same = zstandard.ZstdCompressionParameters.from_level(3, source_size=24 * self.most)
        self.plain = zstandard.ZstdCompressor(compression_params=same)
        self.given = {n: zstandard.ZstdCompressor(compression_params=same, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for n, w in self.words.items()}
        #: Places whose wording was compared, for tests.
        self.confirmed = 0

    def may_hold(self, text: str) -> bool:
        """Whether a text has a word that one of the parts has; a text without any has no match."""
        folded = text.casefold()
        for end, cue in self.cues.iter(folded) if len(self.cues) else ():
            around = folded[max(0, end - len(cue)) : end - len(cue) + 1] + folded[end + 1 : end + 2]
            # Of what is no word character only one sign, an iota below, becomes one when it is folded.
            if not any((c.isalnum() and c != "\u03b9") or c == "_" for c in around):
                return True
        return False

    def windows(self, n: int) -> list[tuple[int, int]]:
        """Stretches of n words, twice as long as the longest template, each half a template on from the last: one of them holds all of a notice."""
        step = max(1, self.most // 2)
        return [(i, min(n, i + 2 * self.most)) for i in range(0, max(n - 2 * self.most + step, 1), step)]

    def reductions(self, words: list[str]) -> list[tuple[int, str, int, int]]:
        """(bytes saved, template, first, last + 1) of every window and template, the most first; of equals the template with more words. Case, line breaks and punctuation don't count."""
        out = []
        for a, b in self.windows(len(words)):
            raw = " ".join(words[a:b]).encode("utf-8", "surrogatepass")
            size = len(self.plain.compress(raw))
            out += [(size - len(z.compress(raw)), n, a, b) for n, z in self.given.items()]
        return sorted(out, key=lambda x: (-x[0], -len(self.words[x[1]]), x[1], x[2]))

    def places(self, words: list[str]) -> list[Place]:
        """Where parts of templates are, by their first word; no match lies elsewhere."""
        at = np.cumsum([1, *[len(w) + 1 for w in words]])
        found: dict[str, list[tuple[int, int, int]]] = {}
        for end, part in self.phrases.iter(f" {' '.join(words)} ") if len(self.phrases) else ():
            p = int(np.searchsorted(at, end - len(part) + 2))
            for n, place, size in self.parts[part]:
                found.setdefault(n, []).append((p - place, p, p + size))
        out = []
        for n, hits in found.items():
            size, allowed, group = len(self.words[n]), self.allowed[n], []
            hits.sort()
            for i, hit in enumerate(hits):
                group.append(hit)
                # Together are parts that one match could hold, so that a text full of notices is not one place.
                if i + 1 == len(hits) or hits[i + 1][0] > group[0][0] + 2 * allowed:
                    out.append(Place(n, size, max(0, group[0][0] - allowed), min(len(words), hit[0] + size + allowed), [(p, q) for _, p, q in group]))
                    group = []
        return sorted(out, key=lambda x: (x.first, x.last, x.name))

    def confirm(self, words: np.ndarray, template: np.ndarray, allowed: int) -> tuple[int, int, int] | None:
        """(differences, first, last + 1) of the stretch that is nearest to the template, if it is near enough."""
        self.confirmed += 1
        inside = np.where(np.isin(template, words), template, -2)
        if (inside == -2).sum() > allowed:
            return None
        different, first, last = best_match(words, inside)
        return (different, first, last) if different <= allowed and first < last else None

    def scan_block(self, words: list[str], places: list[Place]) -> list[tuple[str, int, int, int, int, int]]:
        """(template, first, last + 1, bytes saved, words, differences) of the matches in a block.

        The match with most words that agree, less those that don't, comes first
        and takes its words; then the next of what is left.
        """
        start, end = places[0].first, max(x.last for x in places)
        codes: dict[str, int] = {}
        coded = np.array([codes.setdefault(w, len(codes)) for w in words[start:end]], np.int64)
        templates = {n: np.array([codes.get(w, -2) for w in self.words[n]], np.int64) for n in {x.name for x in places}}
        saved: dict[str, list[tuple[int, int, int]]] = {}
        for bytes_saved, n, a, b in self.reductions(words[start:end]):
            if n in templates:
                saved.setdefault(n, []).append((a, b, bytes_saved))
        firsts: dict[str, list[int]] = {}
        for n, of in saved.items():
            of.sort()
            firsts[n] = [a for a, _, _ in of]
        # Places by the number of words that could agree, in each the one that the compression ranks highest on top.
        open_: dict[int, list[tuple[tuple[int, int, str, int], int, Place]]] = {}
        hits: list[tuple[int, int, int, int, int, str, int, Place]] = []
        near: list[tuple[int, int, Place]] = []
        number = count()

        def put(x: Place) -> None:
            heappush(open_.setdefault(x.size, []), (x.rank(), next(number), x))
            insort(near, (x.first, next(number), x))

        for x in places:
            of, f = saved[x.name], x.first - start
            k = bisect_right(firsts[x.name], f)
            x.saved = max(s for a, b, s in of[max(0, k - 5) : k] if f < b)
            put(x)
        reach, out = max(x.last - x.first for x in places), []
        while True:
            while hits and hits[0][-1].gone:
                heappop(hits)
            for of in open_.values():
                while of and of[0][2].gone:
                    heappop(of)
            # Only a template with as many words as agree in the best match could do better.
            rivals = [n for n, of in open_.items() if of and (not hits or n >= -hits[0][0])]
            if rivals:
                x = heappop(open_[min(rivals, key=lambda n: open_[n][0][:2])])[2]
                m = self.confirm(coded[x.first - start : x.last - start], templates[x.name], self.allowed[x.name])
                if m:
                    heappush(hits, (2 * m[0] - x.size, m[0], -x.saved, x.first + m[1], x.first + m[2], x.name, next(number), x))
                else:
                    x.gone = True
                continue
            if not hits:
                return out
            _, different, _, a, b, name, _, x = heappop(hits)
            out.append((name, a, b, x.saved, x.size, different))
            covered = [y for _, _, y in near[bisect_left(near, (a - reach,)) : bisect_left(near, (b,))] if not y.gone and y.last > a]
            for y in covered:
                y.gone = True
                for rest in y.without(a, b):
                    put(rest)

    def scan(self, text: str) -> list[tuple[str, int, int, int, int, int]]:
        """(license, start, end, bytes saved, words, differences) of every confirmed notice, by place."""
        if not self.may_hold(text):
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        found, block, end = [], [], 0
        for x in self.places(words):
            if block and x.first >= end:
                found += self.scan_block(words, block)
                block = []
            block.append(x)
            end = max(end, x.last)
        if block:
            found += self.scan_block(words, block)
        return sorted((n, spans[a][0], spans[b - 1][1], saved, size, different) for n, a, b, saved, size, different in found)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per license notice in a whole text: doc_id, license, start, end (code points), bytes_saved, n_words, n_different, is_exact.

    Null and empty texts have none, as does an empty table; very long texts are
    read whole, whatever stands between the words of a notice. Repeated
    rows give their notices each. Other columns, whatever their names, are not
    read. Of notices that overlap, the one with most words that agree, less
    those that don't, stays; of equals the one with fewest differences, then the
    one that saves most bytes, then the first; of what that leaves of the others,
    what is near enough by itself. Of stretches that are equally near to a
    template the one that ends first is taken. ``bytes_saved`` may be
    zero or less for a short notice: it ranks, the wording decides.
    """
    ship(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    may = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            out = [(i, *hit, hit[-1] == 0) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for hit in scanner.scan(t.as_py())]
            if out:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "license", "start", "end", "bytes_saved", "n_words", "n_different", "is_exact"])

    return may.mapInArrow(run, SCHEMA)
