"""Importance resampling against plain counting and hashing of every run of words."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import importance, queries
from tests.llm.helpers import awkward, clashing, documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def buckets_of(text: str | None) -> list[int]:
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs: list[tuple], target: list[str | None], percent: int = 5, least: int = 20) -> list[tuple]:
    """(doc_id, n_features, weight, score, rank) in input order."""
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(buckets_of(text))
    for text in target:
        wanted.update(buckets_of(text))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000)))) for b in {*source, *wanted}
    }
    rows = []
    for i, text in docs:
        found = buckets_of(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        weight = sum(gain[b] for b in found)
        rows.append([i, len(found), weight, weight + noise, None])
    eligible = [r for r, (_, text) in zip(rows, docs) if len(words_of(text)) >= least]
    for place, r in enumerate(sorted(eligible, key=lambda r: (-r[3], r[0] is None, r[0] or 0))[: percent * len(eligible) // 100], 1):
        r[4] = place
    return [tuple(r) for r in rows]


def order(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


def texts(n: int) -> list[str]:
    r = random.Random(13)
    vocabulary = ["The", "of", "ünd", "x" * 300, "naïve", "42", "A1"] + [f"w{i}" for i in range(200)]
    breaks = [" ", ", ", "\n", "--", "\t(", "\x7f"]
    return ["".join(r.choice(vocabulary) + r.choice(breaks) for _ in range(r.randint(0, 90))) for _ in range(n)]


@pytest.mark.parametrize("dictionary_size", [0, 40, 1 << 16])
def test_rows_equal_the_plain_ones_whatever_the_dictionary(spark, dictionary_size):
    df = clashing(awkward(spark, texts(150) + ["the of " * 60] * 3))
    target = [None, "", *texts(12), "of the W7"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(df, items, dictionary_size=dictionary_size, percent=30)
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()], target, percent=30)
    assert order(got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == order(want)


def test_registered_query(spark, tmp_path):
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts(120))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "w1 w2 w3 of the")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_importance(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert order(got.collect()) == order(brute([(r[0], r[1]) for r in rows], ["w1 w2 w3 of the"]))


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(empty(spark), items).count() == 0
    got = importance.resample(awkward(spark), items)
    assert got.count() == awkward(spark).count() and got.where("rank is not null").count() == 0


def test_repeated_rows_are_drawn_on_their_own(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = documents(spark, [(7, text, "en", "a", 1)] * 40)
    got = importance.resample(df, spark.createDataFrame([("w1 w2",)], "text string"), percent=25)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 11))


def test_crc_of_joined_strings():
    r = random.Random(1)
    first = [r.randbytes(r.randint(0, 300)) for _ in range(300)]
    second = [r.randbytes(r.choice([0, 1, 5, 255, 256, 257, 1000, 70_000])) for _ in range(300)]
    got = importance.joined_crc(
        np.array([zlib.crc32(a) for a in first], np.uint32), np.array([zlib.crc32(b) for b in second], np.uint32), np.array([len(b) for b in second])
    )
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(first, second)]
