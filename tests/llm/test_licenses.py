"""Patience alignment and license spans."""

from __future__ import annotations

import random
from itertools import combinations

from riskspark.llm import licenses
from tests.llm.helpers import awkward, clashing, empty


def test_increasing_is_longest():
    r = random.Random(1)
    for _ in range(100):
        second = r.sample(range(9), 8)
        got = licenses._increasing(list(enumerate(second)))
        assert [b for _, b in got] == sorted(b for _, b in got)
        longest = max(n for n in range(1, 9) for c in combinations(second, n) if list(c) == sorted(c))
        assert len(got) == longest


def test_align_recurses_into_gaps():
    a, b = "x a b a c d q d e y".split(), "a b a c d d e".split()
    pairs = licenses.align(a, b)
    assert [a[i] for i, _ in pairs] == [b[j] for _, j in pairs] == b
    assert licenses.align(b, b) == [(i, i) for i in range(len(b))]
    assert licenses.align([], b) == []


def test_copies_changes_and_long_texts():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("Software", "Program", 1).replace("free of charge, ", "")
    text = "the of and to " * 3000 + changed + " the copyright notice " * 500 + mit.upper() + " Released under\nthe MIT License!"
    spans = scanner.spans(text)
    assert [s[0] for s in spans] == ["MIT", "MIT", "MIT-notice"]
    assert text[spans[1][1] : spans[1][2]].lower().startswith("permission is hereby")
    assert spans[1][3] == 1.0 > spans[0][3] > 0.9
    assert not scanner.spans(" ".join(sorted(mit.split())))
    assert not scanner.spans("permission is granted to use the software " * 40)


def test_awkward_rows(spark):
    df = clashing(awkward(spark, ["é Licensed under CC BY-NC 4.0. é"]))
    got = {r["doc_id"]: r["spans"] for r in licenses.scan(df).collect()}
    assert [(s["license"], s["start"], s["end"]) for s in got[100]] == [("CC-BY-NC-4.0-notice", 2, 29)]
    assert not any(s for i, s in got.items() if i != 100)
    assert licenses.scan(empty(spark)).count() == 0


def test_whole_texts_and_other_notices():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name in licenses.WHOLE:
        text = licenses.TEMPLATES[f"{name}-text"]
        (span,) = scanner.spans("before " + text + " after")
        assert span[0] == f"{name}-text" and span[3] == 1.0
    for name, text in licenses.TEMPLATES.items():
        assert [s[0] for s in scanner.spans("x " + text + " y")] == [name]
    assert [s[0] for s in scanner.spans("Distributed under the BSD license.")] == ["BSD-notice"]
