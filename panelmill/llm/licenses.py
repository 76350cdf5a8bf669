"""Operator 4: licence scans by conditional compression.

Words that name a licence, copyright or permission are triggers. Candidate blocks are the lines and sentences that a trigger stands
in, runs of lines, and the words around triggers wherever lines are broken. Each block is compressed with each template as a raw
zstandard dictionary and without one; all pairs of block and template are ranked by the bytes that the dictionary saves, and a
template that saves nothing is no candidate. Winners are confirmed in that order by exact wording: where the template's words stand in
the block, by their best local alignments, which of them are there in order (``CONFIRM`` of them or more), and which words differ. What
is confirmed is compressed again on its own, ranked by the bytes saved, then by wording, and reported if its words aren't those of a
better one.

Map-only, whatever the input. Nulls: a null text is an empty one and has no notice. A licence that stands in a text several
times is reported at each place; rows with equal doc_id are scanned one by one; very long texts are scanned whole, region by region. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.decontaminate import align
from panelmill.llm.text import slices, texts

#: Public notices and short licence texts, as licensors ask to state them.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GPL_END = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        _GPL.format(3),
        "SPDX-License-Identifier: GPL-3.0",
        _GPL.format(3) + _GPL_END,
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0",
        _GPL.format(2),
        _GPL.format(2) + _GPL_END,
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        _BSD + _BSD_THIRD + _BSD_END,
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD + _BSD_END],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
TRIGGER = r"(?i)licen[sc]e|copyright|permission|redistribut|public\W+domain|creative\W+commons"
CONFIRM = 0.85
LEVEL = 3

_TRIGGER = re.compile(TRIGGER.removeprefix("(?i)").encode(), re.IGNORECASE)
_WORD = re.compile(r"[\w.]*\w")


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Words:
    """The words of a text, lower-cased, with their places in bytes."""

    def __init__(self, text: bytes) -> None:
        plain = text.decode("utf-8", "surrogateescape")
        found = list(_WORD.finditer(plain))
        self.words = [m[0].lower() for m in found]
        place = lambda x: x
        if len(plain) < len(text):
            code = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            byte = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            byte[(code >= 0xDC80) & (code <= 0xDCFF)] = 1  # bytes that are no UTF-8
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(byte)])
            place = lambda x: int(ends[x])
        self.start, self.end = [place(m.start()) for m in found], [place(m.end()) for m in found]


class Scanner:
    def __init__(self, templates: dict[str, list[str]]) -> None:
        self.rows = [(name, wording(t), zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))) for name, each in templates.items() for t in each]
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.longest = max(len(r[1]) for r in self.rows)
        self.ids = {w: k for k, w in enumerate(sorted({w for _, t, _ in self.rows for w in t}))}

    def judge(self, k: int, words: list[str], lo: int, hi: int) -> tuple[int, int, int] | None:
        """(words in order, first, end) of template k among words lo to hi, if that is enough of it."""
        template = self.rows[k][1]
        pairs = [m for m in SequenceMatcher(None, template, words[lo:hi], autojunk=False).get_matching_blocks() if m.size]
        same = sum(m.size for m in pairs)
        return (same, lo + pairs[0].b, lo + pairs[-1].b + pairs[-1].size) if same and same >= CONFIRM * len(template) else None

    def saved(self, block: bytes) -> list[int]:
        """The bytes that each template saves as a dictionary for the block."""
        plain = len(self.plain.compress(block))
        return [plain - len(dictionary.compress(block)) for _, _, dictionary in self.rows]

    def aligned(self, k: int, words: list[str], lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """(first, end) of template k's local alignments among words lo to hi, the best ones first, each place once. A template without
        enough of its words there, in whatever order, has none."""
        there, wording_ = set(words[lo:hi]), self.rows[k][1]
        if sum(w in there for w in wording_) < CONFIRM * len(wording_):
            return
        template, left = np.array([self.ids[w] for w in wording_]), np.array([self.ids.get(w, -1) for w in words[lo:hi]])
        while True:
            best, end = align(template, left)
            if best < CONFIRM * len(template):
                break
            first = end - align(template[::-1], left[:end][::-1])[1]
            yield lo + first, lo + end
            left[first:end] = -1

    def notices(self, text: bytes) -> Iterator[tuple]:
        """(licence, start, reduction, share of the wording, words missing, words added) of each notice."""
        at = Words(text)
        spans = {(bisect_left(at.start, a), bisect_left(at.start, b)) for a, b in blocks(text)}
        around = 2 * self.longest
        regions: list[list[int]] = []
        for m in _TRIGGER.finditer(text):
            k = bisect_left(at.start, m.start())
            if regions and k - around <= regions[-1][1]:
                regions[-1][1] = min(len(at.words), k + around)
            else:
                regions.append([max(0, k - around), min(len(at.words), k + around)])
        spans.update(map(tuple, regions))
        block = lambda lo, hi: text[at.start[lo] : at.end[hi - 1]].replace(b"\n", b" ")
        pairs = [(-bytes_, k, lo, hi) for lo, hi in spans if lo < hi for k, bytes_ in enumerate(self.saved(block(lo, hi))) if bytes_ > 0]
        found = set()
        for _, k, lo, hi in sorted(pairs):
            found.update((k, *got) for first, end in self.aligned(k, at.words, lo, hi) if (got := self.judge(k, at.words, first, end)))
        ranked = []
        places: dict[int, np.ndarray] = {}
        # A place may lie in several blocks: a template stands where its wording fits best.
        for _, lo, hi, k, same in sorted((len(self.rows[k][1]) + hi - lo - 4 * same, lo, hi, k, same) for k, same, lo, hi in found):
            own = places.setdefault(k, np.zeros(len(at.words), dtype=bool))
            if own[lo:hi].any():
                continue
            own[lo:hi] = True
            name, template, _ = self.rows[k]
            bytes_ = self.saved(block(lo, hi))[k]
            missing, added = len(template) - same, hi - lo - same
            if bytes_ > 0:
                ranked.append((-bytes_, missing + added - 2 * same, -same / len(template), name, lo, hi, missing, added))
        taken = np.zeros(len(at.words), dtype=bool)
        for bytes_, _, share, name, lo, hi, missing, added in sorted(ranked):
            if not taken[lo:hi].any():
                taken[lo:hi] = True
                yield name, at.start[lo], -bytes_ / len(self.plain.compress(block(lo, hi))), -share, missing, added


def blocks(text: bytes) -> Iterator[tuple[int, int]]:
    """Candidate blocks, in bytes: lines, or sentences of long lines, that a trigger stands in, and runs of lines."""
    at = 0
    run: list[tuple[int, int]] = []
    named = False
    for line in text.split(b"\n"):
        trigger = bool(_TRIGGER.search(line))
        if trigger:
            if len(line) > 600:
                for m in re.finditer(rb"(?s).*?(?:[.;:](?:\s|$)|$)", line):
                    if _TRIGGER.search(m[0]):
                        yield at + max(0, m.start() - 300), at + min(len(line), m.end() + 300)
            else:
                yield at, at + len(line)
        if line.strip() and len(line) <= 600:
            run.append((at, at + len(line)))
            named |= trigger
        if not line.strip() or len(run) >= 6:
            if len(run) > 1 and named:
                yield run[0][0], run[-1][1]
            run, named = [], False
        at += len(line) + 1
    if len(run) > 1 and named:
        yield run[0][0], run[-1][1]


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """A row for each notice: doc_id, license, start (byte of its first word), reduction, share, missing, added."""
    schema = "doc_id long, license string, start long, reduction double, share double, missing long, added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for b in slices(batches, "text"):
            rows = [(doc_id, *found) for doc_id, t in zip(b.column(0).to_pylist(), texts(b.column(1))) for found in scanner.notices(t)]
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    named = docs.select(F.col("doc_id").cast("long"), "text").where(F.col("text").rlike(TRIGGER))
    return named.mapInArrow(run, schema)


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
