"""Exact nearest examples against brute force; held-out accuracy; awkward rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import toxicity
from riskspark.llm.base import id_remainder
from tests.llm.helpers import awkward, clashing, documents, empty

BAD = "vile awful rotten nasty".split()


def corpus(spark, n=400):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(r.paretovariate(0.7)) % 500}" for _ in range(60)]
        bad = i % 8 == 0
        if bad:
            for _ in range(5):
                words[r.randrange(60)] = r.choice(BAD)
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, 1, int(bad)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out(spark):
    docs, labels = corpus(spark)
    fold = id_remainder(F.col("doc_id"), 4)
    index = toxicity.fit(docs, labels, fold != 2, per_class=100)
    rows = toxicity.predict(docs, index).where(fold == 2).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["toxic"] == 1) for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(len(r["evidence"]) <= index.k for r in rows)


def test_block_max_search_is_exact():
    r = random.Random(4)
    vocabulary = [f"t{i}".encode() for i in range(40)]
    examples = [(str(i), i % 2, dict(Counter(r.choices(vocabulary, k=r.randint(1, 12))))) for i in range(500)]
    index = toxicity.build(examples, vocabulary, 0.5, 15)
    dense = np.zeros((len(index.labels), 40))
    for t in range(40):
        for e in range(index.entry_of_term[t], index.entry_of_term[t + 1]):
            span = slice(index.starts[e], index.starts[e + 1])
            dense[index.post_doc[span], t] = index.post_weight[span]
    assert np.allclose((dense**2).sum(axis=1), 1)
    for _ in range(60):
        t, w = index.query(Counter(r.choices(vocabulary, k=r.randint(1, 10))))
        scores = dense[:, t] @ w
        docs, got = index.nearest(t, w)
        best = np.sort(scores[scores > 0])[::-1][:15]
        assert np.allclose(got, best) and np.allclose(scores[docs], got)


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 120)
    index = toxicity.fit(docs, labels, F.lit(True))
    df = clashing(awkward(spark, ["vile awful"]))
    got = toxicity.predict(df, index).collect()
    assert len(got) == df.count()
    assert {r["score"] for r in got if not r["evidence"]} == {index.empty}
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 1, 7)], labels.schema))
    assert toxicity.fit(docs, odd, F.lit(True)).names


def test_one_label_or_none(spark):
    docs, labels = corpus(spark, 40)
    for some, share in ((labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0), (labels.limit(0), 0.0)):
        index = toxicity.fit(docs, some, F.lit(True))
        assert {r["score"] for r in toxicity.predict(docs, index).collect()} == {share}
    assert toxicity.predict(empty(spark), index).count() == 0
