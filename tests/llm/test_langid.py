"""Held-out accuracy and the defined results of awkward rows."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import langid
from riskspark.llm.base import id_remainder
from tests.llm.helpers import awkward, clashing, documents, empty

PARTS = {"en": "the ing tion er an of".split(), "de": "der ung sch ich ein ß".split(), "fr": "eau eux é le ment ç".split()}


def labelled(spark, n=240):
    r = random.Random(1)
    rows = []
    for i in range(n):
        lang = list(PARTS)[i % 3]
        text = " ".join("".join(r.choices(PARTS[lang], k=r.randint(1, 3))) for _ in range(r.randint(20, 80)))
        rows.append((1000 + i, text, lang, None, None))
    return documents(spark, rows)


def test_held_out_accuracy_and_rejection(spark):
    df = labelled(spark)
    held = id_remainder(F.col("doc_id"), 5) == 0
    model = langid.fit(df, ~held, max_per_label=60)
    rows = langid.predict(df, model, keep=("doc_id", "lang")).where(held).collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["rejected"] for r in rows]) < 0.05


FOREIGN = {
    "Greek": "Η γλώσσα είναι ένα σύστημα επικοινωνίας που χρησιμοποιούν οι άνθρωποι για να μιλούν μεταξύ τους",
    "Russian": "Язык это система знаков которая служит людям для общения и передачи мысли в повседневной жизни",
    "Chinese": "语言是人类最重要的交际工具是人们进行沟通的主要表达方式",
    "random letters": "qzxkv jwpdg bxqzzj kkvwp zqjxg ywvbk pqxzj vkwjx gqzbd xjkwv zzqpw bvkxj",
    "one letter": "a" * 500,
}


def test_unlearned_texts_are_rejected_and_ties_and_mixtures_kept(spark):
    df = labelled(spark)
    model = langid.fit(df, F.lit(True), max_per_label=60)
    r = random.Random(2)
    halves = [" ".join("".join(r.choices(PARTS[lang], k=2)) for _ in range(40)) for lang in ("en", "de")]
    rows = [(i, text, None, None, None) for i, text in enumerate([*FOREIGN.values(), halves[0], halves[0], halves[1]])]
    got = {x["doc_id"]: x for x in langid.predict(documents(spark, rows), model).collect()}
    assert all(got[i]["rejected"] for i in range(len(FOREIGN)))
    first, again, other = (got[len(FOREIGN) + i] for i in range(3))
    assert first["score"] == again["score"] and not first["rejected"] and not again["rejected"] and not other["rejected"]
    data = " ".join(halves).encode()
    counts = langid.subword_counts(data)
    assert langid._shrunk(counts @ model.familiar, counts.sum(), model.usual) > model.floor


def test_familiarity_judges_each_row_by_the_others():
    texts, y = [b"abc abd", b"abc", b"xyz xyy", b"xyz"], np.array([0, 0, 1, 1])
    counts = [langid.subword_counts(t) for t in texts]
    rows = [(np.flatnonzero(c), c[c > 0]) for c in counts]
    table, usual, _ = langid.familiarity(rows, y, 2)
    size, means = 1 << langid.BUCKET_BITS, []
    for i in range(4):
        p = np.zeros(size)
        for label in (0, 1):
            others = sum((counts[j] for j in range(4) if y[j] == label and j != i), np.zeros(size))
            p += (others + langid.SMOOTH) / (others.sum() + langid.SMOOTH * size) / 2
        means.append(counts[i] @ np.log(p) / counts[i].sum())
    assert np.isclose(usual, np.median(means)) and table.argmax() in rows[1][0].tolist() + rows[3][0].tolist()


def test_clean_rows_of_the_given_table_are_kept(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and text rlike '[a-z]'")
    held = id_remainder(F.col("doc_id"), 5) == 0
    model = langid.fit(df, ~held)
    rows = langid.predict(df, model, keep=("doc_id", "lang")).where(held).collect()
    assert np.mean([r["rejected"] for r in rows]) <= 0.01
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(model.score(text.encode())[2] for text in FOREIGN.values())


def test_awkward_rows(spark):
    model = langid.fit(labelled(spark, 90), F.lit(True))
    df = clashing(awkward(spark, ["123 456 !!", "the theing"]))
    got = langid.predict(df, model, keep=("doc_id", "text")).collect()
    assert len(got) == df.count()
    for r in got:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in PARTS
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns and kept.where("text is null").count() == 0


def test_nothing_to_learn(spark):
    model = langid.fit(empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(awkward(spark), model).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_whole_text_counts_in_pieces(monkeypatch):
    data = ("Straße the tion " * 400).encode()
    whole = langid.subword_counts(data)
    monkeypatch.setattr(langid, "PIECE", 97)
    assert (langid.subword_counts(data) == whole).all()


def test_counts_survive_packing_in_little_room():
    r = random.Random(9)
    counts = langid.subword_counts(" ".join("".join(r.choices(PARTS["en"], k=3)) for _ in range(3000)).encode())
    for some in (counts, np.zeros_like(counts), np.full_like(counts, 100_000)):
        bucket, n = langid._unpacked(langid._packed(some))
        assert (bucket == np.flatnonzero(some)).all() and (n == some[some > 0]).all()
    many = langid.subword_counts(bytes(r.choices(range(97, 123), k=20_000)))
    assert len(langid._packed(many)) < 0.5 * 8 * np.count_nonzero(many)
