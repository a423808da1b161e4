"""License scans by patience alignment.

A text and a template are aligned on the words that occur once in either, kept in the order of a longest increasing
subsequence; the gaps between them are aligned the same way, after equal heads and tails are taken. Coverage is the
share of template words aligned. A template that shares too few words with the text to reach the coverage is passed
over without loss; otherwise stretches of the text, up to one and a half times the template, are chosen by counting
template places per diagonal, so that several copies in one long text are all found.

Null, empty and wordless texts have no spans. Of overlapping spans the one with most aligned words stays (ties: the
first, then the earlier template). Repeated rows get equal results; an empty table gives an empty table; extra
columns are ignored. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F

from riskspark.llm.base import map_rows

# Fixed texts: the wording of public licenses and usual notices.
TEMPLATES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "GPL-2.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-notice": "Released under the BSD License.",
    "ISC-notice": "Released under the ISC License.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "CC0-1.0-notice": "Licensed under CC0 1.0.",
    "CC-BY-3.0-notice": "Licensed under CC BY 3.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-3.0-notice": "Licensed under CC BY-SA 3.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}
# Whole texts, warranty paragraphs and bodies included; a cut copy still gets the span of its part above.
WHOLE = (
    "MIT BSD-2-Clause BSD-3-Clause ISC Unlicense Apache-2.0 GPL-1 GPL-2 GPL-3 LGPL-2 LGPL-2.1 LGPL-3 MPL-1.1 MPL-2.0 CC0-1.0 "
    "GFDL-1.2 GFDL-1.3 Artistic-1.0"
).split()
TEMPLATES |= {f"{name}-text": pkgutil.get_data("riskspark.llm", f"license_texts/{name}.txt").decode() for name in WHOLE}
SPANS = "array<struct<license:string,start:int,end:int,coverage:double>>"
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, sorted by the first place, whose second places increase."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        i = bisect_left(tails, b)
        tails[i:], at[i:] = [b, *tails[i + 1 :]], [k, *at[i + 1 :]]
        back.append(at[i - 1] if i else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of two word lists."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        chain = _increasing([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        if not chain:
            continue
        found += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(found)


class Scanner:
    def __init__(self, templates: Mapping[str, str], coverage: float):
        self.coverage = coverage
        self.templates = [(name, words_of(t)) for name, t in templates.items()]
        self.templates = [(name, t, Counter(t)) for name, t in self.templates if t]
        self.known = {w for _, t, _ in self.templates for w in t}

    def _stretches(self, seen: dict[str, list[int]], template: list[str], need: float) -> list[int]:
        """First places of stretches whose diagonals hold enough different template places."""
        width = max(2, len(template) // 4)
        lines: dict[int, set[int]] = {}
        for q, w in enumerate(template):
            for p in seen.get(w, ()):
                lines.setdefault((p - q) // width, set()).add(q)
        return sorted(
            k * width for k in lines if len(lines[k] | lines.get(k + 1, set()) | lines.get(k + 2, set())) >= need
        )

    def spans(self, text: str | None) -> list[tuple[str, int, int, float]]:
        words = words_of(text or "")
        seen: dict[str, list[int]] = {}
        for p, w in enumerate(words):
            if w in self.known:
                seen.setdefault(w, []).append(p)
        found, places = [], []
        for k, (name, template, counts) in enumerate(self.templates):
            need = self.coverage * len(template)
            if len(words) < need or sum(min(n, len(seen.get(w, ()))) for w, n in counts.items()) < need:
                continue
            places = places or [m.span() for m in _WORD.finditer(text)]
            for start in self._stretches(seen, template, need):
                a = max(0, start)
                stretch = words[a : start + len(template) + max(6, len(template) // 2)]
                pairs = align(stretch, template)
                if len(pairs) >= need:
                    found.append((-len(pairs), places[a + pairs[0][0]][0], k, places[a + pairs[-1][0]][1], len(pairs) / len(template)))
        kept: list[tuple[str, int, int, float]] = []
        for _, start, k, end, share in sorted(found):
            if all(end <= s or e <= start for _, s, e, _ in kept):
                kept.append((self.templates[k][0], start, end, share))
        return sorted(kept, key=lambda s: s[1:3])


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every stretch of every whole text that covers a template."""
    scanner = Scanner(templates, coverage)

    def row(doc_id, text) -> Iterator[tuple]:
        yield doc_id, [dict(zip(("license", "start", "end", "coverage"), s)) for s in scanner.spans(text)]

    kind = dict(docs.dtypes)[id_col]
    return map_rows(docs.select(id_col, F.col(text_col).cast("string")), f"`{id_col}` {kind}, spans {SPANS}", row)
