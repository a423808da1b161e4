"""SimHash groups against all pairs of plain fingerprints."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from riskspark.llm import simhash
from riskspark.llm.components import components
from tests.llm.helpers import awkward, clashing, documents, empty


def plain(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps: list[int], bits: int = 2) -> list[int]:
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints_and_components(spark):
    r = random.Random(2)
    base = [r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randint(0, 40)) for _ in range(300)]
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(300)] = "x"
        texts.append(" ".join(t))
    texts += [" ".join(r.choices(base, k=80)) for _ in range(40)]
    df = clashing(awkward(spark, texts))
    rows = [(x["doc_id"], x["text"]) for x in df.collect()]
    fps = [plain(t) for _, t in rows]
    label = brute(fps)
    least = {k: min((i for (i, _), x in zip(rows, label) if x == k and i is not None), default=None) for k in set(label)}
    want = sorted(((str(i), f, least[k]) for (i, _), f, k in zip(rows, fps, label)), key=str)
    got = sorted(((str(x["doc_id"]), x["fp"] % (1 << 64), x["component_id"]) for x in simhash.near_duplicates(df).collect()), key=str)
    assert got == want


def test_every_link_meets_at_an_anchor():
    r = random.Random(3)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), r.randint(0, 2)):
            y ^= 1 << b
        ax, home = simhash.anchors(x, 2)
        assert home.sum() == 1 and len(set(ax.tolist())) == len(ax)
        assert ax[home][0] in simhash.anchors(y, 2)[0]


def test_large_groups_use_lookups(monkeypatch):
    r = random.Random(4)
    fps = np.array(sorted({sum(1 << b for b in r.sample(range(12), r.randint(0, 6))) for _ in range(200)} | {1 << 40, 1 << 50 | 1 << 41}), np.uint64)
    pairs = simhash._links(fps, 2)
    monkeypatch.setattr(simhash, "PAIRWISE", 1)
    looked = simhash._links(fps, 2)
    for u, v in (pairs, looked):
        node = {int(f): i for i, f in enumerate(fps)}
        label = simhash._forest(len(fps), np.array([node[int(x)] for x in u]), np.array([node[int(x)] for x in v]))
        want = brute([int(f) for f in fps])
        assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


def test_keep_one(spark):
    df = awkward(spark, ["a b c d e f"] * 3)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    groups = {tuple(r) for r in simhash.near_duplicates(df).select("component_id").distinct().collect()}
    assert kept.count() == len(groups)
    assert simhash.keep_one(documents(spark, [(5, "x y z", None, None, None)] * 4)).count() == 1


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (7, 7)], "u long, v long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**{i: 0 for i in range(61)}, 90: 90, 100: 90}
