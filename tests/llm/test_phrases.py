"""Phrase collocations against plain counting of every run of words."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskspark.llm import phrases, queries
from tests.llm.helpers import awkward, clashing, documents, empty
from tests.llm.test_importance import UPPER


def brute(docs: list[tuple], least: int, longest: int = 5, percent: int = 100, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    totals, counts = Counter(), defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    rows = []
    for lang, f in counts.items():
        known = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        inside = set()
        for longer, c in known.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    if 100 * c >= percent * f[longer[i : i + k]]:
                        inside.add(longer[i : i + k])
        found = []
        for p, a in known.items():
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for place, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, place, p.decode(), -a, left, right, totals[lang], -score))
    return rows


def order(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


def corpus(n: int, seed: int = 5) -> list[tuple]:
    r = random.Random(seed)
    words = ["The", "of", "ünd", "a-b", "(x)", " y", "\U0001f600"] + [f"w{i}" for i in range(12)]
    fixed = ["one two three four five six", "New York city", "a a a a a a"]
    out = []
    for i in range(n):
        text = "".join((r.choice(fixed) if r.random() < 0.2 else r.choice(words)) + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " \x0b"]) for _ in range(r.randint(0, 40)))
        out.append((r.choice(["en", "de", None, "ä"]), text))
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("shard_words, least, shared_keys", [(150, 3, 1 << 20), (150, 3, 0), (1 << 21, 12, 0)])
def test_rows_equal_the_plain_ones_however_sharded(spark, monkeypatch, shard_words, least, shared_keys):
    monkeypatch.setattr(phrases, "BROADCAST_KEYS", shared_keys)
    rows = [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(corpus(150))]
    df = clashing(documents(spark, rows).unionByName(awkward(spark, ["the of the of"] * 4)))
    got = phrases.collocations(df, min_count=least, shard_words=shard_words)
    assert order(got.select(*COLUMNS).collect()) == order(brute([(r["lang"], r["text"]) for r in df.collect()], least))


def test_a_share_of_the_longer_phrase_and_a_top(spark):
    docs = corpus(120, 6)
    df = documents(spark, [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(docs)])
    got = phrases.collocations(df, min_count=3, inside_percent=60, top=9, longest=4)
    assert order(got.select(*COLUMNS).collect()) == order(brute(docs, 3, 4, 60, 9))


def test_extensions_are_the_most_frequent_longer_phrases(spark):
    docs = corpus(120, 7)
    df = documents(spark, [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(docs)])
    counts = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                counts[lang or "und"].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    for r in phrases.collocations(df, min_count=4).collect():
        f, size = counts[r["lang"]], len(r["phrase"].split(" "))
        for side, joins in (("left_most", lambda p: p.endswith(" " + r["phrase"])), ("right_most", lambda p: p.startswith(r["phrase"] + " "))):
            longer = [c for p, c in f.items() if joins(p) and len(p.split(" ")) == size + 1 <= 5 and c >= 4]
            assert r[side] == max(longer, default=None)


def test_the_transform_orders_contexts_and_maps_back():
    r = random.Random(3)
    text = np.array([0] + r.choices(range(5), k=400))
    order_, n = phrases.context_order(text, 5), len(text)
    contexts = [tuple(text[(p + k) % n] for k in range(5)) for p in order_]
    assert contexts == sorted(contexts) and sorted(order_.tolist()) == list(range(n))
    index = phrases.Index(text[order_ - 1].astype(np.int32))
    labels, plain = index.words, Counter()
    for size in range(1, 6):
        labels = index.extended(labels) if size > 1 else labels
        starts, counts = index.intervals(labels)
        got = {}
        for row, c in zip(starts.tolist(), counts.tolist()):
            p = []
            for _ in range(size):
                p.append(int(index.first[row]))
                row = int(index.back[row])
            got[tuple(p)] = c
        plain = Counter(t for i in range(n) if 0 not in (t := tuple(int(text[(i + k) % n]) for k in range(size))))
        assert got == dict(plain)


def test_products_beyond_64_bits_are_exact(spark):
    from pyspark.sql import functions as F

    a, n, l, r = 3_000_000_019, 90_000_000_000_000_003, 4_000_000_007, 5_000_000_029
    wide = "CAST({}L AS DECIMAL(19, 0))".format
    got = spark.range(1).select(F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * {wide(a)} * {wide(n)} div ({wide(l)} * {wide(r)})").alias("s")).first()["s"]
    assert got == 1000 * a * n // (l * r)


def test_registered_query(spark, tmp_path):
    docs = corpus(300, 8) * 6
    documents(spark, [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(docs)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_phrases(spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert order(got.collect()) == order(brute(docs, 100))


def test_empty(spark):
    assert phrases.collocations(empty(spark)).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None, None, None), (2, " .,", "en", "a", 3)]), min_count=1).count() == 0


def test_a_staged_shard_is_a_row_group_of_its_own(spark):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from riskspark.sources.staging import stage

    docs = spark.range(24).coalesce(1).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(60_000)), lambda i: F.concat(F.lit("w"), F.xxhash64(i, "id")))).alias("text"))
    index = stage(phrases.shards(docs, F.lit("en"), "text", 1 << 18), large_rows=True)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    assert sum(m.num_rows for m in files) > 3
    assert all(m.num_row_groups == m.num_rows for m in files)


def test_hashes_and_counts_outlast_packing():
    r = np.random.default_rng(4)
    keys = r.integers(0, 1 << 39, 3000, np.uint64)
    keys = np.concatenate([keys, keys[:500], np.array([0, (1 << 39) - 1], np.uint64)])
    counts = r.choice([1, 2, 254, 255, 256, 1 << 40], len(keys))
    plain = Counter()
    for k, n in zip(keys.tolist(), counts.tolist()):
        plain[k] += n
    got = {}
    for bucket, *packed in zip(*(c.to_pylist() for c in phrases._pack(keys, counts).columns)):
        low, n = phrases._unpack(*packed)
        got |= {(bucket << 32) + k: c for k, c in zip(low.tolist(), n.tolist())}
    assert got == dict(plain)


def test_a_task_sends_a_row_per_bucket_and_kind_however_many_its_shards(spark):
    docs = corpus(150, 9)
    df = documents(spark, [(i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(docs)])
    with phrases._rows_per_batch(spark, 5):
        index = phrases.shards(df.coalesce(1), phrases.F.coalesce("lang", phrases.F.lit("und")), "text", 50)
        shards = index.select("kinds", "words", "counts", "codes", "bwt").toArrow()
    assert len(shards) > 20
    every = phrases.Filter(1, None, np.full(phrases.FILTER_BITS >> 3, 255, np.uint8))
    sent = list(phrases._phrases(3, every, every, every)(iter(shards.to_batches(max_chunksize=1))))
    assert sum(b.num_rows for b in sent) <= 2 * 4
    got = Counter()
    for batch in sent:
        for _, kind, joined, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            for phrase, n in zip(joined.split("\n"), phrases._unpack_counts(*packed).tolist()):
                got[kind, phrase] += n
    plain = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            plain.update((lang or "und", " ".join(w[i : i + k])) for k in range(1, 4) for i in range(len(w) - k + 1))
    assert got == plain
