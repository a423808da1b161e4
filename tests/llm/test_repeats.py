"""Exact repeats against a brute-force version over all 200-byte strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import repeats
from tests.llm.helpers import awkward, clashing, documents, empty


def brute(rows: list[tuple[int | None, str | None]], length: int = 200) -> list[tuple]:
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        cover = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cover[s : s + length] = True
        runs = int(np.diff(np.concatenate([[0], cover.astype(np.int8)])).clip(0).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~cover])
        out.append((i, len(b), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed: int) -> list[str]:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, base = prose(60), prose(200)
    near = base.split(" ")
    near[50], near[120] = "changed", "again"
    line = "the very same line. " * 3
    return [
        base, base, " ".join(near), shared + prose(50), prose(30) + shared + prose(5), prose(20) + shared, "ab" * 400,
        "x" * 199, "y" * 200, "z" * 201, prose(10) + line * 20 + prose(10), *(prose(40) + shared[:230] + prose(40) for _ in range(12)),
        "é" * 150 + prose(40), "ü" + "é" * 150,
    ]


@pytest.mark.parametrize("cuts", [{}, {"wide": 2, "huge": 10_000}, {"wide": 1, "huge": 3}])
def test_brute_force(spark, cuts):
    rows = [(i, t) for i, t in enumerate(texts(3))]
    df = documents(spark, [(i, t, None, None, None) for i, t in rows])
    got = sorted(tuple(r) for r in repeats.remove_repeats(df, **cuts).collect())
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_awkward_rows(spark):
    df = awkward(spark, texts(4)[:4])
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [tuple(r) for r in repeats.remove_repeats(clashing(df)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 512)
    data = np.frombuffer(texts(5)[0].encode() * 3, np.uint8)
    hashes, start, after, count = repeats.anchors(data)
    assert count.sum() == len(data) - 199
    assert (np.concatenate([[0], np.cumsum(count)[:-1]]) == start).all()
    assert ((after >= 0) & (after <= 160)).all()


def test_merged_order_is_the_suffix_order_by_symbols():
    r = random.Random(1)
    contexts = ["".join(r.choice("ab") for _ in range(r.randint(8, 30))).encode() for _ in range(20)]
    got = repeats.repeated_starts(contexts, np.ones(20), length=8, symbol=2, shards=3)
    seen = Counter(c[i : i + 8] for c in contexts for i in range(len(c) - 7))
    for c, hit in zip(contexts, got):
        assert hit.tolist() == [seen[c[i : i + 8]] > 1 for i in range(len(c) - 7)]
