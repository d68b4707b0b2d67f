"""License scans by patience alignment of texts with license notices.

A template is a notice's word list. In a stretch of text, words that occur once
in the stretch and once in the template are anchors; the longest increasing
subsequence of them is kept, and the gaps between kept anchors are aligned in
the same way. Coverage is the share of the template's words aligned. Words
outside the template cannot align and only hold positions. A text is cut into
stretches at places where no template word comes for a while, and long stretches are
read in windows, so that a notice in a long document, or its second copy, is aligned by
itself. Aligned words too far from the rest to be of one copy are left out of it.

Names and versions (``IDENTITY``) must stand in a copy without a word between them, so
that a license is not taken for its likes, and a hit inside a longer notice's copy is
part of it. A version is a number: "v3" and "3.0" are "3". Licenses that are not in
``NOTICES`` are not found.

Null texts count as empty and hold no license. Repeated rows are scanned alike;
ties between licenses go to the longer template, then by name.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty

# Names and words of public license notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                         "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
                "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                      "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
                    "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
                    "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                    "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors "
                    "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-4-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
                    "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                    "documentation and/or other materials provided with the distribution. All advertising materials mentioning features or use of this software must "
                    "display the following acknowledgement. Neither the name of the copyright holder nor the names of its contributors "
                    "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD": "Released under the BSD License",
    "BSD-2-Clause-name": "Released under the BSD 2-Clause License",
    "BSD-3-Clause-name": "Released under the BSD 3-Clause License",
    "ISC": "Released under the ISC License",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
                "above copyright notice and this permission notice appear in all copies.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                      "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                       "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                       "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
                       "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                      "You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "Licensed under the Eclipse Public License, Version 2.0",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "CC0-1.0": "Licensed under CC0 1.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
}
for _short, _long in (("", ""), ("-SA", "-ShareAlike"), ("-ND", "-NoDerivatives"), ("-NC", "-NonCommercial"), ("-NC-SA", "-NonCommercial-ShareAlike"),
                      ("-NC-ND", "-NonCommercial-NoDerivatives")):
    NOTICES[f"CC-BY{_short}-4.0-name"] = f"This work is licensed under a Creative Commons Attribution{_long} 4.0 International License"

#: Words that must stand in a copy one after the other, as only they tell the license from its likes: name and version.
#: "version" and "v." may be left out.
IDENTITY = {
    "Apache-2.0": ("apache license version 2.0",), "Apache-2.0-header": ("apache license version 2.0",), "MIT": ("mit license",),
    "MPL-2.0": ("mozilla public license version 2.0",), "MPL-2.0-header": ("mozilla public license v 2.0",), "EPL-2.0": ("eclipse public license version 2.0",),
    "BSL-1.0": ("boost software license version 1.0",), "BSD": ("bsd license",), "BSD-2-Clause-name": ("bsd 2 clause",), "BSD-3-Clause-name": ("bsd 3 clause",),
    "BSD-3-Clause": ("neither the name", "endorse or promote products"), "BSD-4-Clause": ("advertising materials mentioning",),
    "ISC": ("isc license",), "ISC-text": ("provided that the above copyright notice",), "Unlicense": ("free and unencumbered software",), "CC0-1.0": ("cc0 1.0",),
}
for _name, _words in (("GPL", "gnu general"), ("LGPL", "gnu lesser general"), ("AGPL", "gnu affero general")):
    for _version in ("2", "2.1", "3"):
        _key = f"{_name}-{_version if '.' in _version else _version + '.0'}"
        if _key in NOTICES:
            IDENTITY[_key] = (f"{_words} public license version {_version}",)
            IDENTITY[f"{_key}-header"] = (f"{_words} public license", f"version {_version} of the license")
for _name in NOTICES:
    if _name.startswith("CC-BY"):
        IDENTITY[_name] = (NOTICES[_name].split("under ")[1].removeprefix("a ").removesuffix(" International License"),)
COVERAGE = 0.8
#: Notices of so few words that have no identity must be whole: any word may be the name.
SHORT = 12
#: Foreign words that a copy may hold in one place: so many, but no more than GAP_SIZES times the notice's own. Beyond, its two sides
#: are read as texts of their own, as in a long text the words of any notice stand somewhere in order. ``gap=None`` sets no limit.
GAP, GAP_SIZES = 150, 2
#: Words at an end of a copy are strays if the gap before them is so many times as long as they are many.
STRAY = 10
WORD = re.compile(r"\w+(?:\.\d+)*")
VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def plain(word: str) -> str:
    """A version as a number: "3.0", "v3" and "v3.0" are "3"."""
    m = VERSION.fullmatch(word) if word[-1:].isdigit() else None
    return m[1] if m else word


def increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence, by patience piles."""
    tops, piles, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
        before[i] = piles[k - 1] if k else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned pairs of positions, increasing in both."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:  # equal ends align without anchors
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once = _once(template, c, d)
        here = _once(text, a, b)
        anchors = [(i, once[w]) for w, i in sorted(here.items(), key=lambda x: x[1]) if w in once]
        kept = [anchors[i] for i in increasing([j for _, j in anchors])]
        if not kept:
            continue
        out += kept
        for (i, j), (k, m) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)]):
            if k - i > 1 and m - j > 1:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def _once(words: list[str], a: int, b: int) -> dict[str, int]:
    at: dict[str, int] = {}
    twice = set()
    for i in range(a, b):
        if words[i] in at:
            twice.add(words[i])
        at[words[i]] = i
    return {w: i for w, i in at.items() if w not in twice}


#: Words that an identity may have or not.
FILLERS = frozenset(("version", "v"))


class Template:
    def __init__(self, name: str, notice: str, identity: tuple[str, ...] = (), gap: int | None = GAP):
        self.name, self.words = name, [plain(w) for w in words_of(notice)]
        self.identity = [[w for w in map(plain, words_of(x)) if w not in FILLERS] for x in identity]
        self.must = frozenset(w for x in self.identity for w in x)
        self.counts, self.size = Counter(self.words), len(self.words)
        self.vocabulary = frozenset(self.counts)
        self.gap = math.inf if gap is None else max(3, self.size // 2, min(gap, GAP_SIZES * self.size))
        self.need = math.ceil(COVERAGE * self.size - 1e-9) if identity or self.size > SHORT else max(1, self.size)

    def possible(self, words: Iterable[str]) -> bool:
        """Whether a text of these words could align enough: no fewer positions than any alignment has."""
        here = Counter(w for w in words if w in self.vocabulary)
        return sum(min(n, here[w]) for w, n in self.counts.items()) >= self.need

    def stretches(self, found: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
        """Runs of template words that could hold a copy: longer gaps end a run."""
        runs, run = [], []
        for p, w in found:
            if w not in self.vocabulary and w not in FILLERS:
                continue
            if run and p - run[-1][0] > self.gap + 1:
                runs.append(run)
                run = []
            run.append((p, w))
        runs.append(run)
        return [r for r in runs if len(r) >= self.need]

    def pieces(self, run: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
        """A run cut where the template's first two words come again."""
        opening = self.words[:2]
        at = [i for i in range(1, len(run)) if [w for _, w in run[i:i + 2]] == opening]
        return [run[i:k] for i, k in zip([0, *at], [*at, len(run)])]

    def best(self, run: list[tuple[int, str]]) -> list[tuple[int, int]]:
        """The aligned pairs of the span with the most of them; pairs too far off to be of one copy are left out."""
        pairs = align([w for _, w in run], self.words)
        a = top = first = 0
        for b in range(len(pairs)):
            while run[pairs[b][0]][0] - run[pairs[a][0]][0] >= 2 * self.size + self.gap:
                a += 1
            if b + 1 - a > top:
                first, top = a, b + 1 - a
        return pairs[first:first + top]

    def scan(self, found: list[tuple[int, str]]) -> list[tuple[float, int, int]]:
        """(coverage, first word, last word) of each stretch that holds the template."""
        out = []
        for run in self.stretches(found):
            parts = self.pieces(run)
            hits = [h for part in parts for h in self.hits(part)]
            out += hits or (self.hits(run) if len(parts) > 1 else [])
        return out

    def hits(self, run: list[tuple[int, str]]) -> list[tuple[float, int, int]]:
        """The copies in a run, left to right: it is read in windows, as a copy spans two templates and a gap at most."""
        out, at, wide = [], 0, len(run) if self.gap == math.inf else int(3 * self.size + self.gap)
        while len(run) - at >= self.need:
            window = run[at:at + wide]
            hit = self.copy(window) if self.possible(w for _, w in window) else None
            if hit:
                out.append(hit[:3])
                before = run[at:at + hit[3]]
                if len(before) >= self.need and self.possible(w for _, w in before):
                    out += self.hits(before)
                at += hit[4] + 1
            elif at + wide >= len(run):
                break
            else:
                at += self.size
        return sorted(out, key=lambda h: h[1])

    def trimmed(self, run: list[tuple[int, str]], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The pairs without few words at an end that stand far from the rest: STRAY times as far as they are many."""
        far = [k for k in range(1, len(pairs)) if run[pairs[k][0]][0] - run[pairs[k - 1][0]][0] > max(3, self.size // 2)]
        lost = lambda k, n: run[pairs[k][0]][0] - run[pairs[k - 1][0]][0] > STRAY * n
        a, b = 0, len(pairs)
        for k in far:
            if lost(k, k - a) and b - k >= self.need:
                a = k
        for k in reversed(far):
            if k > a and lost(k, b - k) and k - a >= self.need:
                b = k
        return pairs[a:b]

    def copy(self, run: list[tuple[int, str]]) -> tuple[float, int, int, int, int] | None:
        """(coverage, first word, last word, first and last index) of a copy in a run."""
        pairs = self.best(run)
        if not pairs:
            return None
        # once more with what is near alone: words far off may have taken the place of the copy's own
        low, high = run[pairs[0][0]][0] - 2 * pairs[0][1], run[pairs[-1][0]][0] + 2 * (self.size - 1 - pairs[-1][1])
        if len(pairs) < self.need:  # some of it may stand beyond a gap
            low, high = low - self.gap, high + self.gap
        skip = sum(p < low for p, _ in run)
        again = [(i + skip, j) for i, j in self.best([x for x in run if low <= x[0] <= high])]
        pairs = max(pairs, again, key=len)
        if len(pairs) < self.need:
            return None
        pairs = self.trimmed(run, pairs)
        first, last = pairs[0][0], pairs[-1][0]
        if not all(holds(run[first:last + 1], x) for x in self.identity):
            return None
        return len(pairs) / self.size, run[first][0], run[last][0], first, last


def holds(span: list[tuple[int, str]], phrase: list[str]) -> bool:
    """Whether the words of a phrase stand in the span with no other word between them."""
    for i, (p, w) in enumerate(span):
        if w != phrase[0]:
            continue
        k = 1
        for q, v in span[i + 1:i + 3 * len(phrase)]:
            if k == len(phrase) or q != p + 1:
                break
            if v == phrase[k]:
                k += 1
            elif v not in FILLERS:
                break
            p = q
        if k == len(phrase):
            return True
    return False


def outermost(hits: list[tuple]) -> list[tuple]:
    """Hits (size, name, coverage, first, last) without those inside the span of a longer notice."""
    out: list[tuple] = []
    for h in sorted(hits, key=lambda x: (-x[0], -x[2], x[1])):
        if not any(k[3] <= h[3] and h[4] <= k[4] and k[0] > h[0] for k in out):
            out.append(h)
    return out


def scan_text(text: str, templates: list[Template], vocabulary: frozenset) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, last word), best first."""
    found = [(i, w) for i, w in enumerate(map(plain, words_of(text))) if w in vocabulary]
    if not found:
        return []
    present = {w for _, w in found}
    out = []
    for t in templates:
        if t.must <= present and sum(n for w, n in t.counts.items() if w in present) >= t.need:  # positions, as coverage counts them
            out += [(t.size, t.name, *hit) for hit in t.scan(found)]
    out = outermost(out)
    out.sort(key=lambda x: (-x[2], -x[0], x[1], x[3]))
    return [(name, c, a, b) for _, name, c, a, b in out]


OUT = "doc_id long, license string, coverage double, n_licenses int, hits array<struct<license:string,coverage:double,first_word:int,last_word:int>>"


def scan_documents(docs: DataFrame, notices: dict[str, str] | None = None, gap: int | None = GAP) -> DataFrame:
    """Per document: the best license and its coverage (null, 0.0 if none), and every hit with its span of words. ``gap``: see GAP."""
    notices = NOTICES if notices is None else notices

    def make():
        templates = [Template(n, t, IDENTITY.get(n, ()) if t == NOTICES.get(n) else (), gap) for n, t in sorted(notices.items())]
        vocabulary = frozenset(FILLERS).union(*(t.vocabulary for t in templates))

        def f(cols):
            hits = [scan_text(t, templates, vocabulary) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "license": [h[0][0] if h else None for h in hits], "coverage": [h[0][1] if h else 0.0 for h in hits],
                    "n_licenses": [len({x[0] for x in h}) for h in hits],
                    "hits": [[dict(zip(("license", "coverage", "first_word", "last_word"), x)) for x in h] for h in hits]}

        return f

    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")), OUT, make)
