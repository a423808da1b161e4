"""The pipeline against plain versions of its stages, one after the other."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import langid, secrets
from riskspark.llm.base import id_remainder
from tests.llm import test_decontaminate, test_mixing, test_simhash
from tests.llm.helpers import SCHEMA
from tests.llm.test_langid import PARTS

ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    r = random.Random(8)
    item = " ".join(r.choices(PARTS["en"], k=3)) + " window of thirteen quite particular benchmark words that nobody else would ever write"
    rows = []
    for i in range(150):
        lang = list(PARTS)[i % 3]
        text = " ".join("".join(r.choices(PARTS[lang], k=r.randint(1, 3))) for _ in range(r.randint(30, 90)))
        if i % 10 == 1:
            text = rows[-1][1] + ("" if i % 20 == 1 else " end")
        if i % 25 == 2:
            text += " " + item
        if i % 12 == 3:
            text += ' token = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e" ' + "deadbeefdeadbeef"
        rows.append((i, text, lang, f"s{i % 4}" if i % 9 else None, len(text)))
    rows += [(200, None, "en", "s0", None), (201, "", None, None, 0), (202, "123 !", "en", "s1", 5), (203, "язык это система знаков которая служит людям", None, "s1", 44), rows[5], rows[5], (None, "the tion of ing", None, "s2", 15)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], ITEMS).write.parquet(f"{path}/benchmark.parquet")
    return path


def key(row: tuple) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def test_stages_against_plain_versions(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    # Language: letterless texts go, and those that the model of the same rows rejects.
    model = langid.fit(spark.read.parquet(f"{folder}/documents.parquet"), id_remainder(F.col("doc_id"), 5) != 0)
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "") and not model.score(d[1].encode())[2]]
    assert len(docs) > 10 and not any("язык" in d[1] for d in docs)
    # Near-duplicates: the smallest id of each component, null last.
    label = test_simhash.brute([test_simhash.plain(d[1]) for d in docs])
    best = {}
    for d, k in zip(docs, label):
        if k not in best or (d[0] is None, d[0] or 0) < (best[k][0] is None, best[k][0] or 0):
            best[k] = d
    docs = list(best.values())
    docs = [d for d in docs if not test_decontaminate.plain(d[1], items)[-1]]
    clean = []
    for i, text, lang, source, n in docs:
        text = secrets.redacted(text, [s for s in secrets.spans_of(text) if s[0] != "hex"], "[secret]")
        clean.append((i, text, lang, source, len(text)))
    want = test_mixing.plain([(i, t, s) for i, t, _, s, _ in clean])
    got = {key(r[:5]): r for r in (tuple(r) for r in corpus_pipeline.run(spark, folder).collect())}
    wanted = {key(d): want[d[0], d[1], d[3]] for d in clean}
    assert set(got) <= set(wanted)
    for k, (size, total, target, taken) in wanted.items():
        if k in got:
            row = got[k]
            assert (row[5], row[6], row[9]) == (size, total, taken) and abs(row[7] - target) < 1e-6 and row[8] > 0
        else:
            assert taken == 0


def test_stages_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, folder)
        if name != "mix":
            assert out.dtypes == docs.dtypes
        assert out.count() <= docs.count()


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
