"""Gradients, normalisation, lanes, and corpus counts against plain versions."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import grulm
from riskspark.llm.base import id_remainder
from tests.llm.helpers import awkward, clashing, documents, empty

NAMES = ("inputs", "gates", "class_w", "class_b", "word_w", "word_b")


def double(words=100):
    net = grulm.network(words)
    for k in NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    return net


def test_gradients():
    rng = np.random.default_rng(0)
    net = double()
    read, target = rng.integers(0, 100, (6, 3)), rng.integers(-1, 101, (6, 3))
    first, h = rng.random((6, 3)) < 0.3, rng.normal(size=(3, grulm.HIDDEN)) * 0.1
    grads = grulm.gradients(net, read, target, first, h)[0]
    norm = math.sqrt(sum((g * g).sum() for g in grads.values()))
    assert norm < 1
    for name in NAMES[:5]:
        a = getattr(net, name)
        at = (read[2, 1], 5) if name == "inputs" else tuple(rng.integers(0, s) for s in a.shape)
        old, step = a[at], 1e-5
        loss = []
        for v in (old + step, old - step):
            a[at] = v
            loss.append(grulm.gradients(net, read, target, first, h)[1])
        a[at] = old
        assert abs((loss[0] - loss[1]) / 2 / step - grads[name][at]) < 1e-8


def test_probabilities_sum_to_one():
    net = double(70)
    h = np.random.default_rng(1).normal(size=(5, grulm.HIDDEN))
    total = sum(np.exp(grulm.log_probability(net, h, np.full(5, t))) for t in range(71))
    assert np.allclose(total, 1)


def test_lanes_and_windows_do_not_matter():
    rng = np.random.default_rng(2)
    net = double(50)
    reads = [rng.integers(0, 50, n) for n in (1, 700, 3, 40, 41, 1, 130)]
    targets = [np.append(r[1:], 0) for r in reads]
    alone = np.array([grulm.score_texts(net, [r], [t])[0] for r, t in zip(reads, targets)])
    for lanes, window in ((1, 7), (3, 64), (256, 5)):
        assert np.allclose(grulm.score_texts(net, reads, targets, lanes, window), alone, atol=1e-4)


def corpus(spark):
    rows = [(i, " ".join(f"w{(i * j) % (5 + i % 40)} the" for j in range(30)), None, None, None) for i in range(150)]
    return clashing(awkward(spark).union(documents(spark, rows)))


def test_counts_and_model(spark, monkeypatch):
    df = corpus(spark)
    for numbered in (grulm.NUMBERED, 20):
        monkeypatch.setattr(grulm, "NUMBERED", numbered)
        held = id_remainder(F.col("doc_id"), 10) == 0
        vocabulary, net, losses = grulm.fit(df, ~held, sample_texts=200, epochs=12)
        assert losses[-1] < losses[0]
        got = grulm.score(df, held, vocabulary, net).collect()
        rows = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b"\0end"]) for r in df.collect()]
        train = [w for i, w in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
        c = Counter(x for w in train for x in w)
        n, v = sum(c.values()), len(c)
        want = sorted((str(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for i, w in rows)
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
        prose = [r for r in got if r["n_tokens"] == 61]
        assert sum(r["score"] for r in prose) > sum(r["base_score"] for r in prose)


def test_rest_words_share_their_class(spark):
    """The smoothed shares of rest words and one unseen slot add up to one."""
    df = documents(spark, [(i, "a a b c d e f g"[: 3 + 2 * (i % 7)], None, None, None) for i in range(40)])
    vocabulary, net, _ = grulm.fit(df, F.lit(True), epochs=1)
    seen = {r["n_tokens"]: r["score"] for r in grulm.score(df, F.lit(False), vocabulary, net).collect()}
    assert all(s < 0 for s in seen.values())


def test_nothing_to_learn(spark):
    vocabulary, net, losses = grulm.fit(empty(spark), F.lit(True))
    assert losses == [] and grulm.score(empty(spark), F.lit(False), vocabulary, net).count() == 0
    got = grulm.score(awkward(spark), F.lit(True), vocabulary, net).collect()
    assert {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}


def test_every_token_is_learned_and_ranked(spark):
    """Words and windows outside a sample of one text count: ranks, tokens, and the mean of the tasks' networks."""
    df = documents(spark, [(i, "late early " * 400 + f"only{i % 3} " * 200, None, None, None) for i in range(40)])
    vocabulary, net, losses = grulm.fit(df, F.lit(True), sample_texts=1, epochs=1)
    counts = Counter(w for r in df.collect() for w in r["text"].encode().split())
    assert sorted(vocabulary.numbers, key=vocabulary.numbers.get) == sorted(counts, key=lambda w: (-counts[w], w))
    rows = df.select(F.col("text").cast("binary").alias("data")).repartition(3).cache()
    start = grulm.network(vocabulary.words)
    whole, loss, tokens = grulm.learn_all(rows, vocabulary, start)
    assert tokens == 40 * 1001 and loss > 0
    kept, part, share = 0, 0, F.spark_partition_id()
    for k in range(3):
        one = spark.createDataFrame(rows.where(share == k).collect(), rows.schema).coalesce(1)
        alone, _, n = grulm.learn_all(one, vocabulary, start)
        kept, part = kept + n, part + n * alone.class_w.astype(float)
    assert kept == tokens and np.allclose(part / tokens, whole.class_w, atol=1e-5)
    assert len(losses) == 1 and not np.allclose(net.class_w, start.class_w, atol=1e-3)


def test_rows_far_below_others_keep_their_own_scale():
    z = np.array([[0, 1, -1e9], [-500, -501, -1e9], [300, 2, 1]], np.float32)
    top = z.max(axis=1)
    shares = np.exp(z - top[:, None])
    assert np.allclose(grulm._lse(z), top + np.log(shares.sum(axis=1)), rtol=1e-6)
    assert np.allclose(grulm._shares(z), shares / shares.sum(axis=1)[:, None], rtol=1e-6)
    assert len(grulm._lse(z[:0])) == 0 and grulm._shares(z[:0]).shape == (0, 3)


def test_whole_columns_are_numbered_as_single_texts():
    import pyarrow as pa

    listed = [b"a", b"the", b"\xc3\xa9t\xc3\xa9", b"x" * 40]
    known = grulm.Vocabulary({w: i + 1 for i, w in enumerate(listed)}, 3, np.array([0, *(grulm._ending(w) for w in listed)], np.int32))
    texts = [b"The a\x0bb", None, b"", b" \t\r\n", b"Q", "Été ÉTÉ été zz".encode(), b"\x00\xff \x85a a" + b" X" * 3, b"x" * 40, b"rare RARE a " * 250_000]
    numbering, got = grulm.Numbering.of(known), []
    for size in (len(texts), 2):
        got = [r for at in range(0, len(texts), size) for r in numbering.encode(pa.array(texts[at : at + size], pa.binary()))]
        assert len(got) == len(texts)
        for text, (number, read, target, rare) in zip(texts, got):
            plain = known.encode(grulm._words(text))
            assert all(np.array_equal(a, b) for a, b in zip((number, read, target), plain))
            assert sorted(Counter(rare.tolist()).values()) == sorted(Counter(plain[3]).values())
    none = grulm.Numbering.of(grulm.Vocabulary({}, 1, np.array([0], np.int32)))
    assert [r[0].tolist() for r in none.encode(pa.array([b"a b", b""], pa.binary()))] == [[-1, -1, 0], [0]]
