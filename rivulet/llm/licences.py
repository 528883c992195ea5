"""Licence scans: runs of words against licence templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from rivulet.llm.common import adding

SIMILARITY = 0.8

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_NEITHER = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {title} Public License as "
    "published by the Free Software Foundation, {version}. This {what} is distributed in the hope that it will be useful, but WITHOUT "
    "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {title} Public "
    "License for more details."
)
# What licences ask their users to state, and short notices of them.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
    ],
    "BSD": ["Licensed under the BSD License."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD, _BSD + " " + _BSD_END],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.", "Licensed under the 3-clause BSD License.", _BSD + " " + _NEITHER,
        _BSD + " " + _NEITHER + " " + _BSD_END,
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."],
}

for _name, _title, _version in [
    ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.0", "Library General", "2"), ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"),
]:
    _texts = TEMPLATES.setdefault(_name, [])
    _texts += [
        text for text in (
            f"This work is licensed under the GNU {_title} Public License, version {_version}.",
            f"Licensed under the GNU {_title} Public License, version {_version}.",
            *[_GNU.format(what=what, title=_title, version=version) for what in ("program", "library") for version in (
                f"either version {_version} of the License, or (at your option) any later version", f"version {_version} of the License")],
        ) if text not in _texts
    ]
for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
    for _code, _title in [
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ]:
        _texts = TEMPLATES.setdefault(f"CC-{_code}-{_version}", [])
        _kind = "International" if _version == "4.0" else "Unported" if _version == "3.0" else "Generic"
        _texts += [text for text in (
            f"Licensed under CC {_code} {_version}.", f"This work is licensed under a Creative Commons {_title} {_version} {_kind} License.",
            *([] if _version == "4.0" else [f"This work is licensed under a Creative Commons {_title} {_version} License."]),
        ) if text not in _texts]
TOKEN = re.compile(r"[a-z]+|[0-9]+")


def normalised(text: str) -> list[str]:
    """Lower-case words and numbers, without punctuation."""
    return TOKEN.findall(text.lower())


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    """Neighbouring words, the ends of the text included, so that one word has bigrams too."""
    return list(zip(["", *words], [*words, ""])) if words else []


def dice(a: Counter, b: Counter) -> float:
    """Twice the shared bigrams over all, with repeats; 0 for two empty texts."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


#: Words that tell a licence from one with nearly the same text.
VARIANT = set("lesser affero sharealike sa noncommercial nc noderivatives noderivs nd neither".split())
#: Words after which a number is a version.
BEFORE_VERSION = set("version v by sa nc nd attribution sharealike noncommercial noderivatives noderivs zero gpl lgpl agpl cc0".split())


def marks(words: list[str]) -> frozenset[str]:
    """The words of a text that tell versions and variants apart; '2.0' and '2' are the same version."""
    found = VARIANT.intersection(words)
    for i, word in enumerate(words[:-1]):
        if word == "library" and words[i + 1] == "general":
            found.add(word)
        number = words[i + 1]
        if word in BEFORE_VERSION and number.isdigit() and len(number) < 3:
            minor = words[i + 2] if i + 2 < len(words) and words[i + 2] in ("1", "5") else ""
            found.add(f"{number}.{minor}" if minor else number)
    return frozenset(found)


class Index:
    """Templates by size, and which of them have a bigram."""

    def __init__(self, templates: dict[str, list[str]], similarity: float):
        if not 0 < similarity <= 1:
            raise ValueError("similarity must be above 0 and at most 1")
        self.similarity = similarity
        self.all = []
        for name, texts in templates.items():
            for text in texts:
                found = Counter(bigrams(normalised(text)))
                if found:
                    self.all.append((found.total(), name, found))
        self.words = {word for _, _, found in self.all for pair in found for word in pair if word}
        self.marks = []
        self.ends: list[tuple[set, set]] = []  # first and last word of each template
        self.holders: dict[tuple[str, str], list[int]] = defaultdict(list)
        for number, (_, _, found) in enumerate(self.all):
            for pair in found:
                if all(pair):
                    self.holders[pair].append(number)
            self.ends.append(({b for a, b in found if not a}, {a for a, b in found if not b}))
        self.marks = [marks(normalised(text)) for texts in templates.values() for text in texts if normalised(text)]


def _at(template: int, words: list[str], hits: list[int], index: Index) -> list[tuple]:
    """(-coefficient, -words, first word, last word, template) of the runs that are similar enough.

    `hits` are the words that begin a bigram of the template. A run begins and
    ends with a bigram or an end of the template; others are more similar without their first or last word.
    """
    size, _, bag = index.all[template]
    firsts, lasts = index.ends[template]
    similarity = index.similarity
    # the coefficient is at most 2 min / sum, so sizes bound which runs can reach the similarity
    most = int(size * (2 - similarity) / similarity + 1e-9) - 1  # words; a run has one bigram more
    least = size * similarity / (2 - similarity) - 1e-9  # bigrams that are shared at least
    known, finds = set(hits), []
    starts = known | {i for hit in hits for i in (hit, hit + 1) if words[i] in firsts} if hits else {i for i, w in enumerate(words) if w in firsts}
    for begin in sorted(starts):
        stop = min(len(words), begin + most)
        if bisect_left(hits, stop) - bisect_left(hits, begin) + 2 < least:
            continue
        opens = words[begin] in firsts
        seen: Counter = Counter()
        shared = 0
        for end in range(begin, stop):
            if end > begin and end - 1 in known:
                pair = (words[end - 1], words[end])
                seen[pair] += 1
                shared += seen[pair] <= bag[pair]
            closes = words[end] in lasts
            if not closes and (end == begin or end - 1 not in known):
                continue
            value = 2 * (shared + opens + closes) / (size + end - begin + 2)
            if value >= similarity:
                finds.append((-value, begin - end, begin, end, template))
    return finds


def spans(text: str | None, index: Index) -> list[tuple[str, float, int, int, int, int]]:
    """(licence, coefficient, first line, last line, first character, end) of runs of words, without overlaps, in order.

    Of overlapping finds the more similar one stays, then the longer, then the
    earlier one, then the earlier template. Words that tell versions and
    variants apart agree with the template's.
    """
    if not text:
        return []
    lower = text.lower()
    if len(lower) != len(text):  # places must stay
        lower = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    words = TOKEN.findall(lower)
    hits: dict[int, list[int]] = defaultdict(list)
    holders = index.holders
    for place, pair in enumerate(zip(words, words[1:])):
        for template in holders.get(pair, ()):
            hits[template].append(place)
    finds = []
    for template, (size, _, _) in enumerate(index.all):
        if len(hits.get(template, ())) + 2 >= size * index.similarity / (2 - index.similarity) - 1e-9:
            finds += _at(template, words, hits.get(template, []), index)
    if not finds:
        return []
    places = [(m.start(), m.end()) for m in TOKEN.finditer(lower)]
    chosen: list[tuple] = []  # by first word; they do not overlap
    for value, _, begin, end, template in sorted(finds):
        at = bisect_left(chosen, (end + 1,))
        if at == 0 or chosen[at - 1][1] < begin:
            # a clause that comes next belongs to another variant
            if marks(words[begin : end + 1]) != index.marks[template] or ("neither" in words[end + 1 : end + 7] and "neither" not in index.marks[template]):
                continue
            chosen.insert(at, (begin, end, index.all[template][1], -value))
    breaks = [at for at, c in enumerate(text) if c == "\n"]
    return [
        (name, value, bisect_left(breaks, places[begin][0]), bisect_left(breaks, places[end][0]), places[begin][0], places[end][1])
        for begin, end, name, value in chosen
    ]


def licences(text: str | None, index: Index) -> list[tuple[str, float, int, int]]:
    """(licence, coefficient, first line, last line) of `spans`."""
    return [found[:4] for found in spans(text, index)]


@lru_cache(maxsize=4)
def _index(templates: tuple, similarity: float) -> Index:
    return Index({name: list(texts) for name, texts in templates}, similarity)


FOUND = T.ArrayType(T.StructType([
    T.StructField("licence", T.StringType()), T.StructField("dice", T.DoubleType()),
    T.StructField("first_line", T.IntegerType()), T.StructField("last_line", T.IntegerType()),
    T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


def scan(
    docs: DataFrame, text: str = "text", found: str = "licences", templates: dict[str, list[str]] | None = None, similarity: float = SIMILARITY
) -> DataFrame:
    """Add the licences in each whole text: licence, coefficient, first and last line and the characters
    from `begin` to before `end` (all from 0).

    Null and empty texts have none. Repeated rows have the same ones each,
    other columns pass through, an empty table stays empty. Templates are
    named lists of texts; they are sent to the tasks with the plan.
    """
    fixed = tuple((name, tuple(texts)) for name, texts in (TEMPLATES if templates is None else templates).items())
    kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), *[(n, pa.int32()) for n in FOUND.elementType.names[2:]]]))

    def scanned(texts: list) -> list[pa.Array]:
        index = _index(fixed, similarity)
        return [pa.array([[dict(zip(FOUND.elementType.names, x)) for x in spans(t, index)] for t in texts], kind)]

    return adding(docs, text, [T.StructField(found, FOUND)], scanned)
