"""Recall against brute force, exact scores, ties, and rows that take no part."""

from __future__ import annotations

import numpy as np

from riskspark.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r], 0) for i, r in zip(ids, x)], SCHEMA)


def brute(x, ids, k=20, every=20):
    x, ids = np.asarray(x, np.float32).astype(float), np.asarray(ids)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        others = np.flatnonzero(ids != ids[i])
        best = others[np.lexsort((ids[others], -s[others]))[:k]]
        out[int(ids[i])] = [(int(ids[b]), s[b]) for b in best]
    return out


def found(df, **kind):
    out: dict = {}
    for r in sorted(forest.nearest(df, **kind).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)) * rng.uniform(0.5, 1.5, (3000, 1))
    got, want = found(table(spark, x), part_rows=300), brute(x, range(3000))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    for q, rows in got.items():
        for i, s in rows:
            if i in exact[q]:
                assert abs(s - exact[q][i]) < 1e-12


def test_small_table_is_exact_with_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(70, 8))
    x[10:60] = x[0]
    got, want = found(table(spark, x)), brute(x, range(70))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_many_equal_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2400, 16))
    x[::3] = x[0]
    got = found(table(spark, x), part_rows=64, breadth=2.0)
    want = [i for i in range(0, 2400, 3) if i != 0][:20]
    assert [i for i, _ in got[0]] == want


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (1, [0.0, 0.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
        (6, [1.0], 1), (7, [], 1), (None, [1.0, 1.0], 1), (8, [2.0, 2.0], None), (8, [2.0, 2.0], None), (-20, [-1.0, 0.0], 1),
    ]
    got = found(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS part", "3 AS score"))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {0: [8, 20, -20], 20: [8, 0, -20], -20: [20, 0, 8]}
    assert forest.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
