"""License scans: passages of normalised text against templates, by Dice coefficient over word bigrams.

A passage is a run of words and may begin and end at any word. The best one begins
and ends with a bigram of the template, as others at its ends only add to its size.
Its Dice coefficient can reach the threshold only if its number of bigrams lies within
bounds set by the template's, and if it holds enough of the template's bigrams; counts
by text and by window check both, so few windows are compared. ``Scanner`` can also be
held to runs of whole lines.
"""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from listingflow.llm.shared import importable

# Notices, headers and license texts; the long texts are files.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."),
}
_GNU = (
    "This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
    "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} "
    "along with this {what}. If not, see <https://www.gnu.org/licenses/>.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. ")
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES |= {
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + _BSD_NAMES + _BSD_TAIL,
    "GPL-2.0-header": _GNU.format(what="program", colon=";", name="General Public License", version="2"),
    "GPL-3.0-header": _GNU.format(what="program", colon=":", name="General Public License", version="3"),
    "LGPL-2.1-header": _GNU.format(what="library", colon=";", name="Lesser General Public License", version="2.1"),
    "LGPL-3.0-header": _GNU.format(what="program", colon=":", name="Lesser General Public License", version="3"),
    "AGPL-3.0-header": _GNU.format(what="program", colon=":", name="Affero General Public License", version="3"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/"),
    "EPL-1.0-header": (
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. "
        "This work is published under CC0 1.0 Universal."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
        "or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
}
for _part, _name in (("", "Attribution"), ("-SA", "Attribution-ShareAlike"), ("-NC", "Attribution-NonCommercial"), ("-ND", "Attribution-NoDerivatives"),
                     ("-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    TEMPLATES[f"CC-BY{_part}-4.0-notice"] = f"Licensed under CC BY{_part} 4.0."
    TEMPLATES[f"CC-BY{_part}-4.0-header"] = f"This work is licensed under a Creative Commons {_name} 4.0 International License."
for _name in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"):
    TEMPLATES[_name] = pkgutil.get_data(__package__, f"license_texts/{_name}.txt").decode()
DICE = 0.8
WORD = re.compile(r"[^\W_]+")


def bigrams(text: str) -> Counter:
    """Pairs of neighbouring words, lower-cased, with their counts."""
    words = WORD.findall(text.lower())
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


@dataclass(frozen=True)
class Match:
    license: str
    dice: float
    first_line: int
    last_line: int


class Scanner:
    """Templates ready for scanning texts; one with fewer than two words can't match."""

    def __init__(self, templates: dict[str, str], least: float = DICE, lines: bool = True):
        self.least, self.lines = least, lines
        self.templates = [(name, b) for name, text in sorted(templates.items()) if (b := bigrams(text))]
        self.known: dict[tuple[str, str], int] = {}
        for _, pairs in self.templates:
            for pair in pairs:
                self.known.setdefault(pair, len(self.known))
        self.times = np.zeros((len(self.known), len(self.templates)), np.int32)
        for i, (_, pairs) in enumerate(self.templates):
            for pair, n in pairs.items():
                self.times[self.known[pair], i] = n
        self.sizes = np.array([pairs.total() for _, pairs in self.templates])

    def scan(self, text: str | None) -> list[Match]:
        """The best passage for each template that some passage matches; of equals the first, then the shortest."""
        words: list[str] = []
        starts, ends, numbers = [], [], []  # words of the lines that have any
        for number, line in enumerate((text or "").lower().split("\n")):
            found = WORD.findall(line)
            if found:
                starts.append(len(words))
                words += found
                ends.append(len(words))
                numbers.append(number)
        known = self.known
        held = [(at, known[pair]) for at, pair in enumerate(zip(words, words[1:], strict=False)) if pair in known]
        if not held:
            return []
        at, ids = np.array(held).T
        names, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        # a match shares at least as many bigrams as the smallest passage has
        shared = np.minimum(self.times[names], counts[:, None]).sum(axis=0)
        first, last = np.array(starts), np.array(ends)
        out = []
        for i in np.flatnonzero(shared >= self.sizes * self.least / (2 - self.least) - 1e-9):
            name, pairs = self.templates[i]
            times = self.times[names, i][place]
            hits = np.flatnonzero(times)
            if self.lines:
                best = self._best(words, first, last, at[hits], pairs)
            elif best := self._best_window(at[hits], ids[hits], times[hits], int(self.sizes[i])):
                value, a, b = best
                best = value, *(np.searchsorted(first, (a, b + 1), "right") - 1)
            if best:
                value, a, b = best
                out.append(Match(name, value, numbers[a], numbers[b]))
        return out

    def _best_window(self, at, ids, times, size) -> tuple[float, int, int] | None:
        """The best run of words: its Dice coefficient and the places of its first and its last bigram."""
        t = self.least
        low, high = size * t / (2 - t) - 1e-9, size * (2 - t) / t + 1e-9
        # a bigram counts in a window that begins after the one that is as many of its kind back as the template has
        order = np.argsort(ids, kind="stable")
        begin = np.searchsorted(ids[order], ids[order])
        rank = np.arange(len(ids)) - begin
        back = np.empty(len(ids), np.int64)
        back[order] = np.where(rank >= times[order], order[np.maximum(np.arange(len(ids)) - times[order], 0)], -1)
        reach = np.searchsorted(at, at + high, "left")  # windows have at most high bigrams
        best = None
        for i in np.flatnonzero(reach - np.arange(len(at)) >= low):
            shared = np.cumsum(back[i:reach[i]] < i)
            if shared[-1] < low:
                continue
            value = 2 * shared / (at[i:reach[i]] - at[i] + 1 + size)
            j = int(np.argmax(value))
            if value[j] >= t - 1e-9 and (best is None or value[j] > best[0] + 1e-12):
                best = (float(value[j]), int(at[i]), int(at[i + j]))
        return best

    def _best(self, words, first, last, hits, pairs) -> tuple[float, int, int] | None:
        size, t = pairs.total(), self.least
        low, high = size * t / (2 - t) - 1e-9, size * (2 - t) / t + 1e-9
        if len(hits) < low:  # a match shares at least as many bigrams as the smallest passage has
            return None
        # the last line that a run from each line can have
        reach = np.searchsorted(last, first + high + 1, "right") - 1
        ok = reach >= np.arange(len(first))
        held = np.searchsorted(hits, last[np.maximum(reach, 0)] - 1) - np.searchsorted(hits, first)
        best = None
        for a in np.flatnonzero(ok & (held >= low)):
            for b in range(a, reach[a] + 1):
                n = last[b] - first[a] - 1
                shared = np.searchsorted(hits, last[b] - 1) - np.searchsorted(hits, first[a])
                if n < low or 2 * shared < t * (n + size) - 1e-9:
                    continue
                run = words[first[a]:last[b]]
                value = dice(Counter(zip(run, run[1:], strict=False)), pairs)
                if value >= t - 1e-9 and (best is None or value > best[0] + 1e-12):
                    best = (value, int(a), int(b))
        return best


def _scan(templates: dict[str, str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, lines=False)
        for batch in batches:
            rows: dict[str, list] = {"doc_id": [], "license": [], "dice": [], "first_line": [], "last_line": []}
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for m in scanner.scan(text.as_py()):
                    for name, value in zip(rows, (key, m.license, round(m.dice, 6), m.first_line, m.last_line), strict=True):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("doc_id", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())]))

    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = DICE) -> DataFrame:
    """(doc_id, license, dice, first_line, last_line): each template that a passage of (doc_id, text) matches.

    Passages begin and end at any word; the lines are those of its first and last
    word. Lines count from 0. Null and empty texts and lines without words match
    nothing. Repeated rows and null ids give rows of their own.
    """
    importable(docs.sparkSession)
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        _scan(templates, least), "doc_id long, license string, dice double, first_line int, last_line int")
