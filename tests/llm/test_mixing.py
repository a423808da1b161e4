"""Source mixing: targets against a plain version, thresholds against a full sort."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from riskspark.llm import mixing
from tests.llm.helpers import awkward, clashing, documents, empty


def plain(rows: list[tuple]) -> dict[tuple, tuple]:
    """(id, text, source) -> (size, source size, target, taken)."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    mark = lambda i, t: int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16)
    total, per = sum(size(t) for _, t, _ in rows), {}
    for _, t, s in rows:
        per[s] = per.get(s, 0) + size(t)
    names = sorted((s for s in per if s is not None)) + [None] * (None in per)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped: set = set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3.0 * per[s] for s in capped)) / sum(weight[s] for s in free) if free else 0.0
        above = {s for s in free if 3.0 * per[s] <= weight[s] * level}
        if not above:
            break
        capped |= above
    target = {s: 3.0 * per[s] if s in capped else min(3.0 * per[s], weight[s] * level) for s in names}
    out = {}
    for s in names:
        whole = int(target[s] // per[s]) if per[s] else 0
        budget, upto, taken = target[s] - whole * per[s], 0, set()
        groups: dict[int, int] = {}
        for i, t, x in rows:
            if x == s:
                groups[mark(i, t)] = groups.get(mark(i, t), 0) + size(t)
        for h, words in sorted(groups.items()):
            if upto + words <= budget or upto + words - budget < budget - upto:
                taken.add(h)
            if upto + words > budget:
                break
            upto += words
        for i, t, x in rows:
            if x == s:
                out[i, t, s] = size(t), per[s], target[s], size(t) * min(3, whole + (mark(i, t) in taken and per[s] > 0))
    return out


def check(df):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    want = plain(rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    for r in got:
        size, total, target, taken = want[r["doc_id"], r["text"], r["source"]]
        assert (r["size"], r["source_size"], r["taken"]) == (size, total, taken)
        assert abs(r["target"] - target) < 1e-6
        assert r["taken"] <= 3 * r["size"]


def test_against_a_sort(spark):
    rows = [(i, "w " * (i * 7 % 23 + 1), None, "hot" if i % 3 else f"s{i % 11}", None) for i in range(600)]
    check(documents(spark, rows))


def test_awkward_rows_and_ties(spark):
    check(clashing(awkward(spark)))
    check(documents(spark, [(1, "a b c", None, "x", None)] * 5 + [(2, "d e", None, None, None)]))


def test_many_sources_need_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    check(documents(spark, [(i, "w " * (i % 9 + 1), None, f"s{i % 13}", None) for i in range(200)]))


def test_reruns_agree_and_empty(spark):
    df = documents(spark, [(i, "w " * (i % 5), None, f"s{i % 4}", None) for i in range(100)])
    again = [sorted(map(tuple, mixing.mix(df.repartition(n)).select("doc_id", "taken").collect())) for n in (1, 5)]
    assert again[0] == again[1]
    assert mixing.mix(empty(spark)).count() == 0


def test_no_sort_of_documents(spark):
    df = documents(spark, [(i, "w w", None, "s", None) for i in range(50)])
    assert mixing.mix(df).agg(F.max("copies")).first()[0] <= 3
