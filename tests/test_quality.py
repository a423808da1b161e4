import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import quality


def frame(spark, scores, labels):
    return spark.createDataFrame([(float(s), float(y)) for s, y in zip(scores, labels)], "s double, y double")


def brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y > 0]
    neg = [s for s, y in zip(scores, labels) if y <= 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ks = max(abs(np.mean([p <= t for p in pos]) - np.mean([n <= t for n in neg])) for t in set(scores))
    return auc, ks


def test_perfect_separation(spark):
    scores, labels = [i / 17 for i in range(17)], [float(i >= 11) for i in range(17)]
    r = quality.rank_metrics(frame(spark, scores, labels), "s", "y").first()
    assert (r["auc"], r["ks"], r["gini"]) == (*brute(scores, labels), 1.0) == (1.0, 1.0, 1.0)


def test_missing_scores_are_ignored_and_one_class_is_null(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 0.0), ("a", None, 1.0), ("a", float("nan"), 1.0), ("a", 0.9, 1.0), ("a", 0.95, 1.0), ("a", 0.5, None), ("b", 0.4, 1.0)],
        "g string, s double, y double",
    )
    got = {r["g"]: r for r in quality.rank_metrics(df, "s", "y", ["g"]).collect()}
    assert got["a"]["auc"] == 1.0 and got["a"]["n"] == 3
    assert got["b"]["auc"] is None and got["b"]["ks"] is None


def test_ties_and_overdue_days_against_brute_force(spark):
    rng = np.random.default_rng(42)
    scores = [float(x) for x in np.round(rng.random(400), 1)]
    labels = [float(x) for x in rng.choice([0, 0, 0, 15, 30], 400)]
    df = frame(spark, scores, labels)
    auc, ks = brute(scores, labels)
    r = quality.rank_metrics(df, "s", "y").first()
    assert math.isclose(r["auc"], auc) and math.isclose(r["ks"], ks)
    flipped = quality.rank_metrics(df.withColumn("s", -F.col("s")), "s", "y").first()
    assert math.isclose(flipped["ks"], ks) and math.isclose(flipped["auc"], 1 - auc)
    m = quality.multi_label_metrics(df.withColumn("z", F.when(F.col("s") > 0.5, F.col("y"))), [], {"m": "s"}, ["y", "z"])
    got = {x["label"]: x for x in m.collect()}
    assert math.isclose(got["y"]["auc"], auc) and math.isclose(got["y"]["ks"], ks)
    part = [(s, y) for s, y in zip(scores, labels) if s > 0.5]
    zauc, zks = brute([s for s, _ in part], [y for _, y in part])
    assert math.isclose(got["z"]["auc"], zauc) and math.isclose(got["z"]["ks"], zks)


def test_confusion(spark):
    # Two hits, one miss, one false alarm, three right refusals.
    r = quality.confusion_metrics(frame(spark, [0.7, 0.55, 0.45, 0.65, 0.05, 0.15, 0.35], [1, 1, 1, 0, 0, 0, 0.0]), "s", "y").first()
    assert np.allclose([r["accuracy"], r["precision"], r["recall"], r["f1"]], [5 / 7, 2 / 3, 2 / 3, 2 / 3])
    none = quality.confusion_metrics(frame(spark, [0.1], [0.0]), "s", "y").first()
    assert none["precision"] is None and none["recall"] is None and none["f1"] is None


@pytest.mark.parametrize("n", [1, 10, 11, 15, 997])
def test_deciles_follow_row_positions(spark, n):
    rng = np.random.default_rng(n)
    scores = [float(x) for x in (rng.permutation(n) if n < 500 else np.round(rng.random(n), 2))]
    labels = [float(x) for x in rng.integers(0, 2, n)]
    rows = sorted(zip(scores, labels), key=lambda r: (-r[0], r[1]))
    cut = [max(1, math.ceil(i * 10 / (n - 1))) if n > 1 else 5 for i in range(n)]
    table = {r["decile"]: r for r in quality.decile_table(frame(spark, scores, labels), "s", "y").collect()}
    assert set(table) == {11 - c for c in cut}
    for c in set(cut):
        inside = [rows[i] for i in range(n) if cut[i] == c]
        r = table[11 - c]
        assert r["count"] == len(inside)
        assert (r["score_min"], r["score_max"]) == (round(inside[-1][0], 4), round(inside[0][0], 4))
        assert math.isclose(r["label_rate"], sum(y for _, y in inside) / len(inside), abs_tol=1e-6)
    if sum(labels):
        assert table[min(table)]["cum_recall"] == 1.0


def test_split_deciles_cut_tied_counts_like_whole_rows(spark):
    """Few distinct scores, so that nearly every bucket border cuts a tie: each split and ``all`` against their own rows."""
    rows = [("a" if i % 3 else "b", float(i % 4), i % 2, i % 5) for i in range(203)] + [(None, 2.0, 1, 1), ("a", None, 1, 1)]
    df = spark.createDataFrame(rows, "split string, score double, y int, amount int")
    got = quality.split_deciles(df, "score", "y", "split", ["amount"])
    columns = [c for c in got.columns if c != "split"]

    def rows_of(frame):
        return sorted(tuple(r) for r in frame.select(*columns).collect())

    for part, rows_in in (("a", "split = 'a'"), ("b", "split = 'b'"), ("all", "true")):
        alone = quality.decile_table(df.where(rows_in), "score", "y", biz_cols=["amount"])
        assert rows_of(got.where(f"split = '{part}'")) == rows_of(alone)
    assert got.where("split is null").count() == 1


def test_values_are_rounded_as_in_sql(spark):
    import duckdb

    from registry.base import rounded

    values = [k / 1000 + 0.005 for k in range(0, 1000, 10)] + [-0.285, 0.565, 1.005, None, float("nan")]
    df = spark.createDataFrame([(v, v) for v in values], "v double, r double")
    for digits in (2, 8):
        got = {repr(r["v"]): r["r"] for r in rounded(df, digits, "r").collect()}
        for v in values[:-1]:
            assert got[repr(v)] == duckdb.execute(f"SELECT round(CAST(? AS DOUBLE), {digits})", [v]).fetchone()[0]
        assert math.isnan(got["nan"])
