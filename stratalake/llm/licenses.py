"""Licence texts and notices in documents, found by their likeness to templates.

A line, and a block of several lines without a blank one between them, is compared with a template by the Dice coefficient
of their sets of word bigrams. A likeness of at least t bounds the ratio of the two sizes by t / (2 - t), so
only templates within these bounds are candidates, and only those are counted that share a bigram with the text.

A text that is part of a line or block, or spread over several, is found as a passage: a run of words, whatever the lines,
that is like a template and at most twice as long. Only documents with enough of a template's bigrams are searched for its passages.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: notices and texts as the licences themselves word them
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_NO_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. "
)
_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_GNU = (
    "{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
    "version. {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."
)
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_COMMON = (
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", _BSD + _NO_NAMES + _AS_IS),
    ("ISC", _ISC + _NO_WARRANTY),
    ("ISC", _NO_WARRANTY),
    ("0BSD", _ISC.partition(", provided")[0] + ". " + _NO_WARRANTY),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under "
        'copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more "
        "information, please refer to https://unlicense.org",
    ),
    *(
        (f"{name}-{version}{'.0' * ('.' not in version)}-or-later", _GNU.format(what=what, kind=kind, version=version))
        for name, kind, what, versions in (
            ("GPL", "General", "This program", "2"),
            ("LGPL", "Lesser General", "This library", "2.1 3"),
            ("LGPL", "Lesser General", "This program", "2.1 3"),
            ("LGPL", "Library General", "This library", "2"),
            ("AGPL", "Affero General", "This program", "3"),
        )
        for version in versions.split()
    ),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "Licensed under the Apache 2.0 License."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    *(
        (f"{short}-{version}", f"Licensed under the GNU {kind} Public License, version {version.removesuffix('.0')}.")
        for short, kind, versions in (
            ("GPL", "General", "2.0 3.0"),
            ("LGPL", "Lesser General", "2.1 3.0"),
            ("AGPL", "Affero General", "3.0"),
        )
        for version in versions.split()
    ),
    *(
        row
        for short, name in _CC.items()
        for row in (
            (f"CC-{short}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License."),
            (f"CC-{short}-4.0", f"Licensed under CC {short} 4.0."),
        )
    ),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
)
#: Whole licences: files of the folder license_texts.
_WHOLE = {
    "AGPL-3": "AGPL-3.0",
    "Apache-2.0": "Apache-2.0",
    "Artistic": "Artistic-1.0-Perl",
    "BSL-1.0": "BSL-1.0",
    "CC0-1.0": "CC0-1.0",
    "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3",
    "GPL-1": "GPL-1.0",
    "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0",
    "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0",
}
_TEXTS = resources.files(__package__) / "license_texts"
TEMPLATES = tuple(
    dict.fromkeys(
        (*_NOTICES, *_COMMON, *((name, (_TEXTS / file).read_text("utf-8")) for file, name in _WHOLE.items()))
    )
)
#: Likeness from which a text counts as the licence.
PERCENT = 80
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BLANK = re.compile(r"\n[ \t\r]*\n")


def bigrams(text: str) -> set[tuple[bytes, bytes]]:
    """Pairs of neighbours among the runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    words = _WORD.findall(text.encode().lower())
    return set(zip(words, words[1:], strict=False))


class Templates:
    """Templates by size, and by bigram."""

    def __init__(self, templates: tuple[tuple[str, str], ...], percent: int):
        self.percent = percent
        known = sorted((len(b), name, b, text) for name, text in templates if (b := bigrams(text)))
        self.sizes = [k[0] for k in known]
        self.names = [k[1] for k in known]
        #: Bigrams with repeats.
        self.lengths = [len(_WORD.findall(k[3].encode().lower())) - 1 for k in known]
        self.having: dict[tuple[bytes, bytes], list[int]] = {}
        for i, (_, _, own, _) in enumerate(known):
            for b in own:
                self.having.setdefault(b, []).append(i)

    def best(self, text: str) -> tuple[float, str, float] | None:
        """The likest template with at least the wanted likeness, of equals the first by name; and its ``gain``."""
        own, p = bigrams(text), self.percent
        low = bisect_left(self.sizes, len(own) * p / (200 - p))
        high = bisect_right(self.sizes, len(own) * (200 - p) / p)
        if low >= high:
            return None
        shared = Counter(i for b in own & self.having.keys() for i in self.having[b] if low <= i < high)
        found = [
            (-2 * n / (len(own) + self.sizes[i]), self.names[i], 200 * n - p * (len(own) + self.sizes[i]))
            for i, n in shared.items()
            if 200 * n >= p * (len(own) + self.sizes[i])
        ]
        return (-min(found)[0], min(found)[1], min(found)[2]) if found else None

    def passages(self, text: str) -> list[tuple[int, int, float, str, int]]:
        """First and last line, likeness, name and gain of runs of words that are like a template.

        The gain, likeness beyond the wanted one times size, decides between runs that overlap: of nested texts the
        larger one counts, of similar ones the likest.
        """
        words = _WORD.findall(text.encode().lower())
        pairs = list(zip(words, words[1:], strict=False))
        shared = Counter(i for b in set(pairs) & self.having.keys() for i in self.having[b])
        p = self.percent
        wanted = [i for i, n in shared.items() if (200 - p) * n >= p * self.sizes[i]]
        if not wanted:
            return []
        before, at = np.empty(len(pairs), np.int64), {}
        for k, b in enumerate(pairs):
            before[k] = at.get(b, -1)
            at[b] = k
        found = [run for i in wanted for run in self._runs(i, pairs, before)]
        taken, out = np.zeros(len(words), bool), []
        line = np.repeat(*_lines_of_words(text))
        for gain, a, b, dice, name in sorted(found, key=lambda r: (-r[0], r[4], r[1])):
            if not taken[a : b + 2].any():
                taken[a : b + 2] = True
                out.append((int(line[a]), int(line[b + 1]), dice, name, gain))
        return sorted(out)

    def matches(self, text: str) -> list[tuple[int, int, float, str]]:
        """First and last line, likeness and name of the units that match, and then of further passages."""
        whole = [(a, b, *best) for a, b, unit in units(text) if (best := self.best(unit))]
        further = [
            (a, b, dice, name)
            for a, b, dice, name, gain in self.passages(text)
            if not any(x <= b and a <= y and gain <= as_unit for x, y, _, _, as_unit in whole)
        ]
        return [w[:4] for w in whole] + further

    def _runs(self, i: int, pairs: list, before: np.ndarray) -> Iterator[tuple[int, int, int, float, str]]:
        """Gain, first and last bigram, likeness and name of the best run from each place where one may begin.

        A run that has a bigram of the template before it gains by taking it in, so runs begin after others only. A
        run has at most twice as many bigrams, repeats counted, as the template.
        """
        m, p = self.sizes[i], self.percent
        hit = np.fromiter((i in self.having.get(b, ()) for b in pairs), bool, len(pairs))
        reach = 2 * self.lengths[i]
        for a in np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]])):
            new = before[a : a + reach] < a
            n = np.cumsum(new)
            c = np.cumsum(new & hit[a : a + reach])
            gain = 200 * c - p * (n + m)
            k = int(gain.argmax())
            if gain[k] >= 0:
                yield int(gain[k]), int(a), int(a) + k, 2 * int(c[k]) / (int(n[k]) + m), self.names[i]


def _lines_of_words(text: str) -> tuple[np.ndarray, list[int]]:
    """Numbers of lines, and of words in each."""
    counts = [len(_WORD.findall(line.encode().lower())) for line in text.split("\n")]
    return np.arange(len(counts)), counts


def units(text: str) -> Iterator[tuple[int, int, str]]:
    """Lines, and blocks of several lines, with their first and last line."""
    lines = text.split("\n")
    yield from ((i, i, line) for i, line in enumerate(lines))
    at = 0
    for block in _BLANK.split(text):
        n = block.count("\n")
        if n:
            yield at, at + n, block
        at += n + 2


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, matches (first_line, last_line, license, dice; in the order found).

    Lines end at line feeds and count from 0; blocks end at lines of blanks only. A unit matches its likest template if
    their Dice coefficient is at least ``percent`` / 100. Passages (see ``Templates.passages``) come after the units, with
    the lines on which they begin and end, unless they overlap a unit that matches with as much gain.

    A null or empty text, and a unit of fewer than two words, matches nothing. Repeated rows and null ids are rows like
    others, other columns are ignored, an empty table gives no rows.
    """
    kind = pa.list_(
        pa.struct([("first_line", pa.int32()), ("last_line", pa.int32()), ("license", pa.string()), ("dice", pa.float64())])
    )
    known = Templates(templates, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = [
                [{"first_line": a, "last_line": b, "license": name, "dice": dice} for a, b, dice, name in known.matches(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(matches, kind)], names=["doc_id", "matches"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, matches array<struct<first_line:int,last_line:int,license:string,dice:double>>"
    )
