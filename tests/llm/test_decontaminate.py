"""Benchmark windows against a plain scan."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from riskspark.llm import decontaminate
from tests.llm.helpers import awkward, clashing, documents, empty

ITEMS = "item_id long, text string"


def split(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text: str | None, items: list[tuple]) -> tuple:
    words, hit, ids = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(13, len(w))
        for a in range(len(w) - n + 1) if w else ():
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[a : a + n]:
                    hit |= set(range(p, p + n))
                    ids.add(item)
    names = sorted(str(i) for i in ids if i is not None)
    return len(words), len(hit), names, len(hit) > 0 and 20 * len(hit) >= len(words)


def check(df, bench):
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    want = sorted((str(r["doc_id"]), *plain(r["text"], items)) for r in df.collect())
    got = decontaminate.judge(df, bench).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    return want


def test_plain_scan(spark):
    r = random.Random(5)
    prose = lambda n: " ".join(r.choice("the of a to in is".split()) + r.choice(["", "x", "y", "zz"]) for _ in range(n))
    items = [(i, prose(r.choice([1, 3, 12, 13, 14, 40]))) for i in range(12)] + [(50, None), (51, " , "), (52, "Äpfel 12 Ü"), (53, "Äpfel 12 Ü"), (None, prose(20))]
    texts = [prose(200) for _ in range(5)]
    for _, t in items:
        w = (t or "").split()
        a = r.randint(0, max(0, len(w) - 13))
        texts += [prose(30) + " " + " ".join(w[a : a + 13]).upper() + "; " + prose(30), t or "", " ".join(w[1:]), prose(400) + " " + (t or "")]
    want = check(clashing(awkward(spark, texts)), spark.createDataFrame(items, ITEMS))
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)


def test_repeated_words_and_rows(spark):
    bench = spark.createDataFrame([(1, "a a a a a a a a a a a a a a a a"), (1, "a a b"), (2, "a a b")], ITEMS)
    df = documents(spark, [(1, "a " * 40, None, None, None)] * 2 + [(1, "a a b a a b", None, None, None), (2, "a " * 12, None, None, None)])
    check(df, bench)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "some words")], ITEMS)
    assert decontaminate.judge(empty(spark), bench).count() == 0
    check(awkward(spark), spark.createDataFrame([], ITEMS))


def test_drop_keeps_all_clean_rows(spark):
    df = documents(spark, [(1, "one two three", None, None, None)] * 2 + [(1, "clean text", None, None, None), (None, None, None, None, None)])
    bench = spark.createDataFrame([(9, "one two three")], ITEMS)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(str(r["text"]) for r in kept.collect()) == ["None", "clean text"]


def test_words_are_counted_in_any_case(spark):
    texts = ["Ab CD, eF", "A@B[C`d{E", " ÄB\x7f9z ", "", None, "Z", "...", "İX KELVIN\u212a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(decontaminate.word_count(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(split(t)) for t in texts]


def test_dropping_shuffles_no_text(spark):
    df = documents(spark, [(i, f"one two three {i}" if i % 3 else f"clean text {i}", None, None, None) for i in range(30)])
    kept = decontaminate.drop_contaminated(df, spark.createDataFrame([(9, "one two three")], ITEMS))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert kept.count() == 10


def test_no_python_in_the_plan(spark):
    bench = spark.createDataFrame([(9, "one two three")], ITEMS)
    plan = decontaminate.judge(awkward(spark), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(?!Eval)|CartesianProduct", plan)
