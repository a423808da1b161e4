"""The n-gram Jaccard join against all pairs of plain sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from riskspark.llm import jaccard, queries
from tests.llm.helpers import awkward, clashing, documents, empty


def plain(text: str | None, width: int = 3) -> frozenset:
    w = (text or "").encode().lower().split()
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs: list[tuple], percent: int = 90, width: int = 3) -> list[tuple]:
    found = [plain(t, width) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(found[i] & found[j])
            if found[i] and found[j] and label[i] != label[j] and 100 * both >= percent * len(found[i] | found[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {k: min((d for (d, _), x in zip(docs, label) if x == k and d is not None), default=None) for k in set(label)}
    return [(d, len(f), least[x]) for (d, _), f, x in zip(docs, found, label)]


def order(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


def edited(r: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        at = r.randrange(len(words))
        what = r.random()
        if what < 0.6:
            words[at] = f"new{r.randrange(10**6)}"
        elif what < 0.8 and len(words) > 4:
            del words[at]
        else:
            words.insert(at, f"more{r.randrange(10**6)}")
    return " ".join(words)


def corpus(seed: int, groups: int, copies: int) -> list[str]:
    """Groups of near copies around the threshold, of many sizes, and texts that share passages and frequent words."""
    r = random.Random(seed)
    out, passage = [], [f"p{i}" for i in range(40)]
    for _ in range(groups):
        size = r.choice([3, 8, 11, 12, 13, 14, 21, 22, 30, 60, 120, 400])
        base = [r.choice("the of and a".split()) if r.random() < 0.4 else f"v{r.randrange(3000)}" for _ in range(size)]
        for _ in range(r.randint(1, copies)):
            out.append(edited(r, base, r.randint(0, max(1, size // 40))))
    for _ in range(20):
        out.append(" ".join(passage + [f"u{r.randrange(10**6)}" for _ in range(r.randint(0, 6))]))
    return out


@pytest.mark.parametrize("percent, seed", [(90, 1), (80, 2)])
def test_components_equal_all_pairs(spark, percent, seed):
    df = clashing(awkward(spark, corpus(seed, 40, 8)))
    got = jaccard.join(df, percent=percent)
    assert order(got.collect()) == order(brute([(r["doc_id"], r["text"]) for r in df.collect()], percent))


def test_a_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 10)
    r = random.Random(9)
    base = [f"w{r.randrange(2000)}" for _ in range(90)]
    texts = [edited(r, base, r.choice([1, 2, 3, 5])) for _ in range(220)]
    df = documents(spark, [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)])
    assert order(jaccard.join(df).collect()) == order(brute(list(enumerate(texts))))


def test_linked_pairs_share_a_tile_and_pass_the_signature():
    r = random.Random(4)
    for _ in range(1500):
        n, percent = r.choice([1, 5, 9, 10, 11, 12, 13, 18, 19, 20, 27, 28, 29, 41, 42, 100, 333, 2000]), r.choice([90, 80])
        base = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        drop, add = r.randint(0, n // 8), r.randint(0, n // 8)
        other = np.unique(np.concatenate([base[drop:], np.array([r.getrandbits(64) for _ in range(add)], np.uint64)]))
        if not len(other):
            continue
        both = len(np.intersect1d(base, other))
        assert jaccard.overlap(base, other) == both
        differ = jaccard.differing(jaccard.signature(base), jaccard.signature(other))
        assert differ <= len(base) + len(other) - 2 * both
        if 100 * both >= percent * (len(base) + len(other) - both):
            assert jaccard.may_link(len(base), len(other), differ, percent)
            assert set(jaccard.tiles(base, percent).tolist()) & set(jaccard.tiles(other, percent).tolist())


def test_registered_query(spark, tmp_path):
    texts = corpus(3, 15, 4)
    documents(spark, [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_jaccard(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert order(got.collect()) == order(brute(list(enumerate(texts))))


def test_empty(spark):
    assert jaccard.join(empty(spark)).count() == 0
    assert order(jaccard.join(documents(spark, [(3, None, None, None, None), (2, " \n", None, None, 2), (1, "", None, None, 0)])).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
