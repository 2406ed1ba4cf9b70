"""Licence templates found in texts by the Dice coefficient over word bigrams."""

from __future__ import annotations

import bisect
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, with_text

LEAST = 0.8
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."


def gnu(name: str, version: int) -> str:
    """The header that the licence of that name and version asks for in each file."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
    )


#: (licence, text): short notices, standard headers and whole texts. Callers may give others.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", MIT),
    ("BSD-2-Clause", f"{BSD}\n{BSD_END}"),
    ("BSD-3-Clause", f"{BSD}\n{BSD_THIRD}\n{BSD_END}"),
    ("ISC", ISC),
    ("Zlib", ZLIB),
    ("Unlicense", UNLICENSE),
    ("BSL-1.0", BOOST),
    ("Apache-2.0", APACHE),
    ("MPL-2.0", MPL),
    ("GPL-2.0", gnu("General Public License", 2)),
    ("GPL-3.0", gnu("General Public License", 3)),
    ("LGPL-3.0", gnu("Lesser General Public License", 3)),
    ("AGPL-3.0", gnu("Affero General Public License", 3)),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]
#: Digits, a-z and all that isn't ASCII are words; A-Z lower-cased, other ASCII is space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def bigrams(w: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(w, w[1:], strict=False))


class Matcher:
    """Templates of two words or more, by the size of their bigram sets.

    2 |A & B| / (|A| + |B|) >= t needs t / (2 - t) <= |A| / |B| <= (2 - t) / t, so a unit of text meets the templates of
    about its size only, and a template needs |A & B| >= t / (2 - t) * |B| of its bigrams somewhere in the text.
    """

    def __init__(self, templates, least: float):
        self.least, self.low = least, least / (2 - least)
        made = [(name, w) for name, t in templates if len(w := words(t.encode())) > 1]
        self.sets = sorted(((len(s := bigrams(w)), name, len(w), s) for name, w in made), key=lambda x: x[:3])
        self.sizes = [x[0] for x in self.sets]
        self.fewest = (self.sizes[0] * self.low if self.sizes else 0) + 1
        self.of = defaultdict(list)  # the templates that hold a bigram
        for k, x in enumerate(self.sets):
            for b in x[3]:
                self.of[b].append(k)
        self.first = {b[0] for b in self.of}

    def unit(self, w: list[bytes]) -> tuple[float, str] | None:
        """The best template for the whole of w (ties: the first name)."""
        if len(w) < self.fewest or not self.sizes:
            return None
        if len(w) > 4 * self.sizes[-1] and len(set(w)) > self.sizes[-1] / self.low + 1:
            return None  # as many distinct words start at least that many bigrams but one
        a = bigrams(w)
        lo, hi = bisect.bisect_left(self.sizes, len(a) * self.low), bisect.bisect_right(self.sizes, len(a) / self.low)
        found = [(2 * len(a & s) / (len(a) + n), name) for n, name, _, s in self.sets[lo:hi]]
        found = [x for x in found if x[0] >= self.least]
        return min(found, key=lambda x: (-x[0], x[1])) if found else None

    def windows(self, w: list[bytes]):
        """(score, name, first word, words) of the runs of words as long as a template that reach the least score: of those that overlap, the best for that template."""
        hits = defaultdict(list)  # by template the places of its bigrams
        for i, b in enumerate(zip(w, w[1:], strict=False)):
            if b[0] in self.first and b in self.of:
                for k in self.of[b]:
                    hits[k].append(i)
        for k, places in hits.items():
            size, name, length, own = self.sets[k]
            if len(places) < self.low * size:
                continue
            best = None
            # windows start at a place of a template's bigram, or end with one: others hold no more of them
            for start in sorted({max(0, min(x, len(w) - length)) for x in places} | {max(0, x + 2 - length) for x in places}):
                lo, hi = bisect.bisect_left(places, start), bisect.bisect_right(places, start + length - 2)
                if hi - lo < self.low * size:
                    continue
                a = bigrams(w[start : start + length])
                score = 2 * len(a & own) / (len(a) + size)
                if score < self.least:
                    continue
                if best and start < best[2] + best[3]:
                    if score > best[0]:
                        best = (score, name, start, min(length, len(w) - start))
                    continue
                if best:
                    yield best
                best = (score, name, start, min(length, len(w) - start))
            if best:
                yield best


def scan(text: bytes | None, m: Matcher) -> list[tuple[str, float, int, int]]:
    """(template, score, first line, lines) of what in a text is a template, by line.

    Units are its lines, its paragraphs and the whole text; besides, runs of words as long as a template, wherever they
    start and end, so that a notice within a longer line or wrapped over lines is found. A run is added unless a match
    on its lines scores as well or better.
    """
    lines = (text or b"").split(b"\n")
    by_line = [words(x) for x in lines]
    flat = [x for w in by_line for x in w]
    if len(flat) < m.fewest or m.first.isdisjoint(flat):
        return []
    start, units = 0, {(i, 1) for i, w in enumerate(by_line) if w} | {(0, len(lines))}
    for i, w in enumerate([*lines, b""]):
        if not w.strip():
            if i - start > 1:
                units.add((start, i - start))
            start = i + 1
    out = []
    for i, n in sorted(units):
        if found := m.unit(by_line[i] if n == 1 else [x for w in by_line[i : i + n] for x in w]):
            out.append((found[1], found[0], i, n))
    ends = []  # the words up to the end of each line
    for w in by_line:
        ends.append((ends[-1] if ends else 0) + len(w))
    for score, name, at, n in sorted(m.windows(flat), key=lambda x: (-x[0], x[1], x[2])):
        i, j = bisect.bisect_right(ends, at), bisect.bisect_left(ends, at + n)
        if not any(x[1] >= score and x[2] <= j and i < x[2] + x[3] for x in out):
            out.append((name, score, i, j - i + 1))
    return sorted(out, key=lambda x: (x[2], x[3], x[0]))


def find_licenses(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """docs with licenses: array of struct(license, score, line, lines), by line; empty where nothing is found.

    Texts are normalised to words; units and runs of words meet the templates that the size bounds leave. Null and empty
    texts have none; repeated rows get the same. Texts are scanned whole, each in its own row; the templates are the
    caller's pairs of a name and a text (of one word or none: never found). A clashing column is replaced.
    """
    names = ("license", "score", "line", "lines")
    run = lambda texts, m: [([dict(zip(names, x, strict=True)) for x in scan(t, m)],) for t in texts]
    return with_text(docs.drop("licenses"), run, "licenses array<struct<license:string,score:double,line:int,lines:int>>", lambda: Matcher(templates, least))


def op1_licenses(spark, sf_dir) -> DataFrame:
    found = find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"])))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_units"), F.concat_ws(",", names).alias("licenses"), F.array_max(F.transform("licenses", lambda x: x["score"])).alias("best_score"))
