"""License scans by patience alignment with license templates.

Words are runs of letters and digits, lower-cased. A text and a template are aligned as by patience
sorting: words that occur once in both are candidates, the longest increasing subsequence of
their places gives the anchors, and the gaps between anchors are aligned in turn; before that,
equal words at both ends of a gap are matched. Coverage is the share of the template's words that
are matched. A template may occur anywhere in a text, also repeatedly, so windows of 1.5 times its
length are aligned, beginning at each of its words in the ranges of the text that hold enough of
its words. A range without them can't reach the coverage, so none is missed.

A text holds a license where coverage reaches ``COVERAGE`` and the phrases that tell the license from
its neighbours (name, version, own clauses) are matched word by word without a gap; a phrase of
a neighbour inside the match bars it. One-line notices must stand in the text whole, without gaps,
and not go on with a hyphen (``MIT-0`` is not ``MIT``). A match inside a longer match of another license
is dropped; of several templates of one license the best counts. Null and empty texts hold none; repeated rows are separate; ties go to the longer
template, then to the license's name; an empty list of templates finds nothing.
"""

from __future__ import annotations

import bisect
import itertools
import re
import uuid
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import once, per_text, pick

COVERAGE = 0.8
_WORD = re.compile(r"[^\W_]+")
_GOES_ON = re.compile(r"-[^\W_]")



class Template(NamedTuple):
    license: str
    text: str
    phrases: tuple[str, ...] = ()  # parts of the text that must be matched without a gap
    barred: tuple[str, ...] = ()  # words in a row that only a neighbour has
    whole: bool = False  # must stand in the text whole, without a gap


def _gnu(license: str, kind: str, version: str, subject: str = "program") -> Template:
    name = f"GNU {kind}General Public License"
    return Template(license, f"""This {subject} is free software: you can redistribute it and/or modify it under the terms of the
{name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any
later version. This {subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.""",
    (f"terms of the {name}", f"version {version} of the License"))


def _gnu_head(license: str, kind: str, version: str, date: str) -> Template:
    title = f"GNU {kind}General Public License Version {version}, {date}"
    return Template(license, f"""{title} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and
distribute verbatim copies of this license document, but changing it is not allowed.""", (title,))


_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution."""
_BSD_ADVERTISING = """All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED."""
_BSD_LIABILITY = """IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ENDORSE, _ADVERTISE = "endorse or promote products derived from this software", "All advertising materials mentioning features"

# Public license texts and notices, by license.
TEMPLATES: list[Template] = [
    Template("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""", ("included in all copies or substantial portions",)),
    Template("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""", ("Apache License, Version 2.0",)),
    Template("BSD-2-Clause", f"{_BSD_START} {_BSD_END}", (), (_ENDORSE, _ADVERTISE)),
    Template("BSD-2-Clause", f"{_BSD_START} {_BSD_END} {_BSD_LIABILITY}", (), (_ENDORSE, _ADVERTISE)),
    Template("BSD-3-Clause", f"{_BSD_START} 3. {_BSD_NAMES} {_BSD_END}", (_ENDORSE,), (_ADVERTISE,)),
    Template("BSD-3-Clause", f"{_BSD_START} 3. {_BSD_NAMES} {_BSD_END} {_BSD_LIABILITY}", (_ENDORSE,), (_ADVERTISE,)),
    Template("BSD-4-Clause", f"{_BSD_START} 3. {_BSD_ADVERTISING} 4. {_BSD_NAMES} {_BSD_END}", (_ADVERTISE, _ENDORSE)),
    _gnu("GPL-2.0", "", "2"),
    _gnu("GPL-3.0", "", "3"),
    _gnu("LGPL-2.1", "Lesser ", "2.1", "library"),
    _gnu("LGPL-3.0", "Lesser ", "3"),
    _gnu("AGPL-3.0", "Affero ", "3"),
    _gnu_head("GPL-2.0", "", "2", "June 1991"),
    _gnu_head("GPL-3.0", "", "3", "29 June 2007"),
    _gnu_head("LGPL-2.1", "Lesser ", "2.1", "February 1999"),
    _gnu_head("LGPL-3.0", "Lesser ", "3", "29 June 2007"),
    _gnu_head("AGPL-3.0", "Affero ", "3", "19 November 2007"),
    Template("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""", ("with or without fee",)),
    Template("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""", ("Mozilla Public License, v. 2.0",)),
]

# Names of licenses in notices; a version without its zero also stands for the one with it.
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT License", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License v2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSD-4-Clause": ["BSD 4-Clause License", "4-Clause BSD License"],
    "ISC": ["ISC License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"],
    **{
        f"{short}-{number}": [
            f"{name}{form}"
            for name in (f"GNU {kind}General Public License", f"{kind}General Public License", f"GNU {short}", short)
            for n in (number, number.removesuffix(".0"))
            for form in (f", version {n}", f" v{n}", f" v. {n}", f" {n}")
        ]
        for short, kind, number in [
            ("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0"),
        ]
    },
    **{
        f"CC-{parts}-4.0": [f"CC {parts} 4.0", f"Creative Commons {name} 4.0 International License", f"Creative Commons {name} 4.0"]
        for parts, name in [
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        ]
    },
}
_FRAMES = ["", "the ", "a ", "an ", "the terms of the ", "the terms of "]
_SUFFIXES = ["", "-only", "-or-later"]
TEMPLATES += [
    Template(license, f"{start}under {frame}{name}", whole=True)
    for license, names in NAMES.items() for name in names for frame in _FRAMES
    for start in ("", "Licensed ", "Released ", "This work is licensed ")
]
TEMPLATES += [
    Template(license, f"SPDX-License-Identifier: {license}{suffix}", whole=True)
    for license in NAMES for suffix in (_SUFFIXES if "GPL" in license else [""])
]


@dataclass(frozen=True)
class Match:
    license: str
    coverage: float
    words: int  # of the template
    start: int  # character offsets in the text
    end: int


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    pile: list[int] = []
    below = [-1] * len(values)
    for i, value in enumerate(values):
        k = bisect.bisect_left(tops, value)
        below[i] = pile[k - 1] if k else -1
        if k == len(tops):
            tops.append(value)
            pile.append(i)
        else:
            tops[k], pile[k] = value, i
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def _single(words: list[str], first: int, end: int) -> dict[str, int]:
    """Places of the words that occur once in the range."""
    places: dict[str, int] = {}
    for i in range(first, end):
        places[words[i]] = -1 if words[i] in places else i
    return {w: i for w, i in places.items() if i >= 0}


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places (in text, in template), both increasing."""
    out: list[tuple[int, int]] = []
    open_gaps = [(0, len(text), 0, len(template))]
    while open_gaps:
        a, b, c, d = open_gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        once_text, once_template = _single(text, a, b), _single(template, c, d)
        shared = sorted((once_template[w], i) for w, i in once_text.items() if w in once_template)
        anchors = [shared[k] for k in increasing([i for _, i in shared])]
        if not anchors:
            continue
        for (j, i), (j_next, i_next) in zip([(c - 1, a - 1), *anchors], [*anchors, (d, b)], strict=True):
            if j_next < d:
                out.append((i_next, j_next))
            if i + 1 < i_next and j + 1 < j_next:
                open_gaps.append((i + 1, i_next, j + 1, j_next))
    return sorted(out)


def matched(found: list[tuple[int, int]], template: list[str], phrase: list[str]) -> bool:
    """Whether some place of the phrase in the template is matched word by word without a gap."""
    at = {j: i for i, j in found}
    return any(
        template[j : j + len(phrase)] == phrase and j in at and all(at.get(j + k) == at[j] + k for k in range(len(phrase)))
        for j in range(len(template) - len(phrase) + 1)
    )


def occurs(phrase: list[str], words: list[str]) -> bool:
    return any(words[i : i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def outer(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Matches but those inside a longer match of another license."""
    out: list[tuple[str, float, int, int, int]] = []
    reach: dict[str, int] = {}  # largest end by license, of longer matches that begin no later
    ordered = sorted(dict.fromkeys(found), key=lambda m: (m[3], -m[4]))
    for (_, b), group in itertools.groupby(ordered, key=lambda m: (m[3], m[4])):
        same = list(group)
        out += [m for m in same if not any(end >= b for name, end in reach.items() if name != m[0])]
        reach.update((m[0], max(reach.get(m[0], 0), b)) for m in same)
    return out


class Scanner:
    """Aligns texts with all templates."""

    def __init__(self, templates: list[tuple], coverage: float = COVERAGE):
        self.coverage = coverage
        given = [(Template(*t), words_of(t[1])) for t in templates]
        self.templates = [
            (t.license, words, [words_of(p) for p in t.phrases], [words_of(p) for p in t.barred])
            for t, words in given if words and not t.whole
        ]
        self.notices: dict[tuple[str, ...], list[str]] = {}
        for t, words in given:
            if words and t.whole:
                self.notices.setdefault(tuple(words), []).append(t.license)
        self.lengths: dict[tuple[str, ...], list[int]] = {}  # of the notices, by their first two words
        for words in self.notices:
            self.lengths.setdefault(words[:2], []).append(len(words))
        self.lengths = {start: sorted(set(n)) for start, n in self.lengths.items()}
        self.vocabulary = {w for _, words, *_ in self.templates for w in words} | {start[0] for start in self.lengths}

    def whole_notices(self, words: list[str], places: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
        """``license, first, end`` of every notice that stands in the text whole."""
        out = []
        for i, w in places:
            for n in (*self.lengths.get((w, *words[i + 1 : i + 2]), ()), *self.lengths.get((w,), ())):
                if i + n <= len(words):
                    out += [(name, i, i + n) for name in self.notices.get(tuple(words[i : i + n]), ())]
        return out

    def regions(self, places: list[tuple[int, str]], template: list[str]) -> list[tuple[int, int]]:
        """Ranges of the text where enough of the template's words lie close together.

        ``places`` are the text's words that some template has. A range has 1.5 times the template's
        length; with fewer of its words than the coverage asks for (with repeats), it can't reach it.
        """
        wanted: dict[str, int] = {}
        for w in template:
            wanted[w] = wanted.get(w, 0) + 1
        own = [(i, w) for i, w in places if w in wanted]
        need = self.coverage * len(template)
        width = max(len(template) + 4, len(template) * 3 // 2)
        out: list[tuple[int, int]] = []
        held: dict[str, int] = {}
        have = first = 0
        for i, w in own:
            held[w] = held.get(w, 0) + 1
            have += held[w] <= wanted[w]
            while own[first][0] <= i - width:
                old = own[first][1]
                have -= held[old] <= wanted[old]
                held[old] -= 1
                first += 1
            if have >= need:
                start = own[first][0]
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((start, i + 1))
        return out

    def best_window(
        self, words: list[str], template: list[str], first: int, end: int, phrases: list[list[str]], barred: list[list[str]],
    ) -> tuple[float, int, int]:
        """Best coverage among the windows of a region that begin at a word of the template and hold its phrases."""
        width = max(len(template) + 4, len(template) * 3 // 2)
        best = (0.0, first, first)
        own = set(template)
        for start in range(first, end):
            if words[start] not in own:
                continue
            found = align(words[start : min(end, start + width)], template)
            share = len(found) / len(template)
            if share < self.coverage or share <= best[0] or not all(matched(found, template, p) for p in phrases):
                continue
            a, b = start + found[0][0], start + found[-1][0] + 1
            if any(occurs(p, words[a:b]) for p in barred):
                continue
            best = (share, a, b)
            if share == 1.0:
                break
        return best

    def __call__(self, text: str | None) -> list[Match]:
        """Licenses of a text, each with its best template, by coverage."""
        words = words_of(text or "")
        places = [(i, w) for i, w in enumerate(words) if w in self.vocabulary]
        found = []  # license, coverage, words of the template, first and end word
        for name, template, phrases, barred in self.templates if places else ():
            for first, end in self.regions(places, template):
                share, a, b = self.best_window(words, template, first, end, phrases, barred)
                if share >= self.coverage:
                    found.append((name, share, len(template), a, b))
        notices = self.whole_notices(words, places)
        if not found and not notices:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        found += [(name, 1.0, b - a, a, b) for name, a, b in notices if not _GOES_ON.match(text, spans[b - 1][1])]
        best: dict[str, tuple] = {}
        for name, share, n, a, b in outer(found):
            if name not in best or (share, n) > best[name][:2]:
                best[name] = (share, n, a, b)
        kept = [Match(name, share, n, spans[a][0], spans[b - 1][1]) for name, (share, n, a, b) in best.items()]
        return sorted(kept, key=lambda m: (-m.coverage, -m.words, m.license))


def scan(
    docs: DataFrame, templates: list[tuple] | None = None, doc_id: str = "doc_id", text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """``doc_id, licenses``: array of (license, coverage, words, start, end), best first.

    Documents are scanned where they are read; the templates (a fixed list) go along with the code.
    """
    key = uuid.uuid4().hex
    item = pa.struct([
        ("license", pa.string()), ("coverage", pa.float64()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
    ])

    def derive(texts):
        scanner = once(key, lambda: Scanner(TEMPLATES if templates is None else templates, coverage))
        return [pa.array([[vars(m) for m in scanner(t)] for t in texts], pa.list_(item))]

    kind = "array<struct<license:string,coverage:double,words:int,start:int,end:int>>"
    return per_text(pick(docs, doc_id=doc_id, text=text), f"licenses {kind}", derive)


def digest(found: DataFrame) -> DataFrame:
    """The best license of each document, its coverage and the number of licenses."""
    best = F.try_element_at("licenses", F.lit(1))
    return found.select(
        "doc_id", best["license"].alias("license"), F.round(F.coalesce(best["coverage"], F.lit(0.0)), 6).alias("coverage"),
        F.size("licenses").cast("long").alias("n_licenses"), best["start"].alias("start"), best["end"].alias("end"),
    )
