import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark import SplitSpec
from riskspark.operators import bins, iv, profile, stability


def pandas_iv(x, y, n=10):
    edges = pd.qcut(x, n, duplicates="drop", retbins=True)[1]
    cut = pd.cut(x, edges, include_lowest=True)
    good, bad = (y == 0).groupby(cut, observed=True).sum(), (y == 1).groupby(cut, observed=True).sum()
    g, b = (good / good.sum()).clip(lower=1e-4), (bad / bad.sum()).clip(lower=1e-4)
    return float(((g - b) * np.log(g / b)).sum())


def pandas_psi(base, actual, n=10):
    edges = pd.qcut(base, n, duplicates="drop", retbins=True)[1]
    a, b = (pd.cut(s, edges, include_lowest=True).value_counts(normalize=True).sort_index() for s in (actual, base))
    return float(((a - b) * np.log((a + 1e-10) / (b + 1e-10))).sum())


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"x": rng.normal(size=1500), "few": rng.integers(0, 4, 1500).astype(float)})
    pdf["zero"] = np.where(rng.random(1500) < 0.4, 0.0, rng.exponential(size=1500))
    pdf["y"] = (pdf["x"] + rng.normal(size=1500) > 0).astype(float)
    pdf.loc[:60, "y"] = np.nan
    pdf.loc[50:120, "x"] = np.nan
    pdf["month"] = np.where(np.arange(1500) < 900, "2026-01", "2026-02")
    return pdf


def spark_frame(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), ", ".join(
        f"{c} {'string' if c == 'month' else 'double'}" for c in pdf.columns
    ))


def test_iv_equals_pandas(spark, frame):
    df = spark_frame(spark, frame)
    got = {r["feature"]: r["iv"] for r in iv.feature_iv(df, "y", ["x", "few", "zero"]).collect()}
    for f in got:
        rows = frame[[f, "y"]].dropna()
        assert math.isclose(got[f], pandas_iv(rows[f], rows["y"]), rel_tol=1e-9), f


def test_iv_is_null_for_one_class_or_few_rows(spark):
    rows = [(float(i), 1.0, float(i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, one double, y double")
    assert iv.feature_iv(df, "one", ["x"]).first()["iv"] is None
    assert iv.feature_iv(df.limit(15), "y", ["x"]).first()["iv"] is None


def test_psi_by_month_and_between_samples(spark, frame):
    df = spark_frame(spark, frame)
    got = {(r["feature"], r["month"]): r["psi"] for r in stability.monthly_psi(df, "month", ["x", "zero"], "2026-01").collect()}
    one, two = frame[frame.month == "2026-01"], frame[frame.month == "2026-02"]
    for f in ("x", "zero"):
        assert got[f, "2026-01"] == 0.0
        assert math.isclose(got[f, "2026-02"], pandas_psi(one[f].dropna(), two[f].dropna()), rel_tol=1e-9)
    far = df.where("month = '2026-02'").withColumn("x", F.col("x") + 3)
    assert stability.feature_psi(df.where("month = '2026-01'"), far, ["x"]).first()["psi"] > 0.1
    assert stability.feature_psi(df.limit(2), df, ["x"]).first()["psi"] is None


def test_unsmoothed_psi_is_infinite_on_an_empty_bin(spark):
    rows = [("a", float(i)) for i in range(40)] + [("b", float(i % 10)) for i in range(40)]
    df = spark.createDataFrame(rows, "m string, x double")
    smooth = {r["m"]: r["psi"] for r in stability.monthly_psi(df, "m", ["x"], "a").collect()}
    raw = {r["m"]: r["psi"] for r in stability.monthly_psi(df, "m", ["x"], "a", zero_bin="inf").collect()}
    assert raw["b"] == float("inf") and 1 < smooth["b"] < 100 and raw["a"] == 0.0


def test_psi_of_shares(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.7)], "bin int, share double")
    b = spark.createDataFrame([(1, 0.7), (2, 0.2), (3, 0.1)], "bin int, share double")
    assert stability.psi_proportions(a, a).first()["psi"] == 0.0
    assert stability.psi_proportions(a, b).first()["psi"] > 0.1


def test_bins_are_right_closed_with_lowest_included(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 41)], "x double")
    got = {r["value"]: r["bin"] for r in bins.bin_assign(df, ["x"], n_bins=4).collect()}
    want = pd.cut(pd.Series(range(1, 41), dtype=float), pd.qcut(pd.Series(range(1, 41)), 4, retbins=True)[1], include_lowest=True, labels=False) + 1
    assert [got[float(i)] for i in range(1, 41)] == list(want)


def test_distribution_and_monthly_stats(spark, frame):
    df = spark_frame(spark, frame)
    d = {r["feature"]: r for r in profile.feature_distribution(df, ["x", "zero"]).collect()}
    assert math.isclose(d["x"]["coverage"], frame.x.notna().mean())
    assert math.isclose(d["x"]["q25"], frame.x.quantile(0.25)) and math.isclose(d["zero"]["q99"], frame.zero.quantile(0.99))
    m = {r["month"]: r for r in profile.monthly_feature_stats(df, "month", ["x"]).collect()}
    sub = frame[frame.month == "2026-01"].x
    assert math.isclose(m["2026-01"]["std"], sub.std()) and m["2026-01"]["n_unique"] == sub.nunique()


def test_overview_segments_and_verdicts(spark):
    days = ["20260401", "20260402", "20260501", "20260502", "20260503"]
    rows = [(f"u{u}", int(u < 2), d) for d in days for u in range(10)]
    df = spark.createDataFrame(rows, "fuid string, label int, f_p_date string")
    o = profile.sample_overview(df, "fuid", "f_p_date", "label")
    r = o.first()
    assert (r["total_samples"], r["positive_samples"], r["n_users"], r["n_days"], r["duplicate_rows"]) == (50, 10, 10, 5, 0)
    seg = {x["month"]: (x["samples"], x["positive"]) for x in profile.label_segments(df, "f_p_date", "label").collect()}
    assert seg == {"202604": (20, 4), "202605": (30, 6)}
    assert profile.sample_sufficiency(o).first()["verdict"] == "insufficient"
    for rates, verdict, spread in (([0.11, 0.13, 0.15], "significant", 4.0), ([0.13, 0.135], "stable", 0.5)):
        t = spark.createDataFrame([(f"20260{i + 1}", x) for i, x in enumerate(rates)], "month string, positive_rate double")
        s = profile.label_stability(t).first()
        assert (s["verdict"], s["volatility_pp"]) == (verdict, spread)
    split = profile.split_summary(df, "f_p_date", "label", SplitSpec({"train": ("20260401", "20260430"), "oot": ("2026-05-01", "2026-05-31")}))
    assert {x["split"]: x["rows"] for x in split.collect()} == {"train": 20, "oot": 30}
    for pos, total, want in ((15000, 150000, "ample"), (5000, 50000, "usable"), (100, 1000, "insufficient")):
        t = spark.createDataFrame([(pos, total)], "positive_samples long, total_samples long")
        assert profile.sample_sufficiency(t).first()["verdict"] == want
