"""License scans by patience alignment.

A template's three-word runs point out the regions of a text that may hold it.
Copies that follow each other would blur the alignment, so a region is also cut
where the next one begins, and each place of the template in it is tried alone.
A region and the template are aligned: words that occur once in both are
anchors, the longest increasing subsequence of them is kept, and the gaps
between are aligned in the same way, where other words are unique.  Coverage is
the share of the template's words that are aligned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import rows, text_column

#: Smallest coverage that is reported, and words of a run that points out a region.
MIN_COVERAGE, SEED_WORDS = 0.8, 3
_WORD = re.compile(r"[^\W_]+")

# Public license notices and statements, by SPDX identifier: short
# statements, opening paragraphs as they are often quoted, and whole notices.
# ``load_templates`` adds whole license texts from a folder.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
        "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
        "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative "
        "works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE "
        "IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS "
        "OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License "
        "for more details.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License "
        "for more details.",
    ),
)


def load_templates(folder: str) -> tuple[tuple[str, str], ...]:
    """License texts of a folder of the driver, named by their files: to be added to
    TEMPLATES.  Links to another file of the folder are left out."""
    files = sorted(p for p in Path(folder).iterdir() if p.is_file() and not p.is_symlink())
    return tuple((p.name, p.read_text(errors="replace")) for p in files)


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second places increase; the first ones do."""
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        before.append(last[k - 1] if k else -1)
        tails[k:] = [b, *tails[k + 1 :]]
        last[k:] = [i, *last[k + 1 :]]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience_align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (in a, in b) of aligned equal words, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a1, a2, b1, b2 = gaps.pop()
        while a1 < a2 and b1 < b2 and a[a1] == b[b1]:
            out.append((a1, b1))
            a1, b1 = a1 + 1, b1 + 1
        while a1 < a2 and b1 < b2 and a[a2 - 1] == b[b2 - 1]:
            a2, b2 = a2 - 1, b2 - 1
            out.append((a2, b2))
        if a1 == a2 or b1 == b2:
            continue
        once_a, once_b = Counter(a[a1:a2]), Counter(b[b1:b2])
        place = {b[j]: j for j in range(b1, b2) if once_b[b[j]] == 1}
        anchors = _increasing([(i, place[a[i]]) for i in range(a1, a2) if once_a[a[i]] == 1 and a[i] in place])
        out += anchors
        if anchors:
            ends = [(a1 - 1, b1 - 1), *anchors, (a2, b2)]
            gaps += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(ends, ends[1:]) if x + 1 < y and u + 1 < v]
    return sorted(out)


class Templates:
    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in templates]
        self.words = [words_of(text) for _, text in templates]
        self.seeds: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for n, words in enumerate(self.words):
            if len(words) < SEED_WORDS:
                raise ValueError("a template needs three words")
            for at in range(len(words) - SEED_WORDS + 1):
                self.seeds.setdefault(tuple(words[at : at + SEED_WORDS]), []).append((n, at))

    def regions(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(template, from, to) of the stretches that share runs with a template
        in about the same places: with a margin, cut at the neighbours, and for
        each place alone."""
        starts: dict[int, list[int]] = {}
        seeds = self.seeds
        for i, run in enumerate(zip(words, words[1:], words[2:])):
            if run in seeds:
                for n, at in seeds[run]:
                    starts.setdefault(n, []).append(i - at)
        out = []
        for n, found in starts.items():
            size = len(self.words[n])
            slack = 3 + size // 4
            found = sorted(set(found))
            spans = []
            first = last = found[0]
            for x in [*found[1:], None]:
                if x is None or x - last > slack:
                    spans.append((first, last))
                    first = x
                last = x
            stretches = {(x, x + size) for x in found}
            for (_, before), (first, last), (after, _) in zip([(0, -size), *spans], spans, [*spans[1:], (len(words), 0)]):
                stretches.add((first - slack, last + size + slack))
                low, high = min(first, before + size), max(last + size, after)
                stretches.add((max(first - slack, low), min(last + size + slack, high)))
            out += sorted({(n, max(0, a), min(len(words), b)) for a, b in stretches})
        return out

    def find(self, text: str, min_coverage: float) -> list[tuple[str, int, int, int, int]]:
        """(license, start, end, aligned words, template's words) in code points.
        Of overlapping finds the one with most aligned words stays, then the one
        with most coverage, then the first template, then the shortest."""
        words = words_of(text)
        found = []
        for n, a, b in self.regions(words):
            size = len(self.words[n])
            aligned = patience_align(words[a:b], self.words[n])
            if aligned and len(aligned) >= min_coverage * size - 1e-9:
                found.append((len(aligned), len(aligned) / size, n, a + aligned[0][0], a + aligned[-1][0]))
        if not found:
            return []
        places = [m.span() for m in _WORD.finditer(text)]
        # By start; finds that were taken don't overlap, so only two neighbours can.
        taken: list[tuple[int, int, int, int]] = []
        for matched, _, n, a, b in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[4] - x[3], x[3])):
            at = bisect_left(taken, (a,))
            if (at == 0 or taken[at - 1][1] < a) and (at == len(taken) or taken[at][0] > b):
                taken.insert(at, (a, b, n, matched))
        return [(self.names[n], places[a][0], places[b][1], matched, len(self.words[n])) for a, b, n, matched in taken]


@lru_cache(maxsize=2)
def _compiled(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(templates)


def scan_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """doc_id and licenses, an array of (license, start, end, matched, words,
    coverage), for every row.

    A find needs one three-word run of its template, in place: a text with a word
    put in after every second one has none and isn't found.  Null text counts
    as empty; repeated rows give equal rows; columns other than doc_id and text
    are ignored.  No shuffle.
    """
    kind = pa.struct(
        [("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("words", pa.int64()), ("coverage", pa.float64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _compiled(templates)
        names = ["license", "start", "end", "matched", "words", "coverage"]
        for batch in rows(batches):
            found = [
                [dict(zip(names, (*x, x[3] / x[4]))) for x in known.find(text, min_coverage)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], ["doc_id", "licenses"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(
        scan,
        "doc_id long, licenses array<struct<license:string,start:long,end:long,matched:long,words:long,coverage:double>>",
    )
