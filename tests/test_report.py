"""Report tables against plain pandas/numpy evaluations of their definitions."""

import math

import numpy as np
import pandas as pd
import pytest

from riskspark.operators import report
from riskspark.plans.flows import ReportConfig, evaluation_report


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 1200
    new = np.round(np.clip(rng.beta(2, 6, n), 0, 1), 2)
    return pd.DataFrame(
        {
            "uid": [f"u{i % 700}" for i in range(n)], "day": [f"2026-0{1 + i * 3 // n}-15" for i in range(n)],
            "if_tf": np.where(np.arange(n) % 50 == 0, 0, 1), "fpd7_sx30": np.where(rng.random(n) < new, 1.0, 0.0),
            "score_new": new, "score_old": np.round(new * 0.5 + rng.random(n) * 0.4, 3), "pos": np.arange(n),
        }
    )


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def frame(pdf):
    rows = pdf[pdf.if_tf == 1].assign(month=lambda x: x.day.str[:7])
    return rows.groupby(["month", "uid"], as_index=False).first()


def test_report_frame_and_whole_report(df, frame):
    config = ReportConfig(
        "uid", "day", {"new": "score_new", "old": "score_old"}, ("fpd7_sx30",), ("2026-02", "2026-03"), "2026-02",
        ("pos",), {"if_tf": 1},
    )
    tables = evaluation_report(df, config)
    assert tables["frame"].count() == len(frame)
    stats = {r["month"]: r for r in tables["month_stats"].collect()}
    jan = frame[frame.month == "2026-01"]
    assert stats["2026-01"]["users"] == jan.uid.nunique() and stats["2026-01"]["bad"] == int(jan.fpd7_sx30.sum())
    assert {"lift", "swap", "ks_delta", "checks"} <= set(tables)
    assert not any(r["failed"] for r in tables["checks"].collect())
    oot = frame[frame.month >= "2026-02"]
    swap = {(r["old_bin"], r["new_bin"]): (r["n"], r["bad"]) for r in tables["swap"].collect()}
    ob, nb = (pd.qcut(oot[c], 5, duplicates="drop", labels=False) + 1 for c in ("score_old", "score_new"))
    for o in range(1, ob.max() + 1):
        for w in range(1, nb.max() + 1):
            cell = oot[(ob == o) & (nb == w)]
            assert swap[o, w] == (len(cell), int(cell.fpd7_sx30.sum()))
    assert swap[None, None] == (len(oot), int(oot.fpd7_sx30.sum()))
    lift = [r for r in tables["lift"].collect() if r["model"] == "new" and r["bin"]]
    assert sum(r["n"] for r in lift) == len(oot)


@pytest.mark.parametrize("scale", [1.0, 300.0])
def test_score_bins_follow_the_histogram_rules(spark, frame, scale):
    rows = frame.assign(score=np.round(frame.score_new * scale + (0 if scale == 1 else 400), 3))
    df = spark.createDataFrame(rows[["month", "score", "fpd7_sx30"]])
    raw = np.array([k / 10 for k in range(11)])
    if scale != 1.0:
        raw = np.arange(math.floor(rows.score.min() / 10) * 10, math.ceil(rows.score.max() / 10) * 10 + 1, 10.0)
    share = np.max([np.histogram(g.score, raw)[0] / len(g) for _, g in rows.groupby("month")], axis=0)
    kept = np.flatnonzero(share >= 0.01)
    edges = sorted({raw[0], *raw[kept[0] + 1 : kept[-1] + 1], raw[-1]})
    bins = sorted(report.score_bins(df, "month", "score").collect(), key=lambda r: r["bin"])
    assert [bins[0]["low"], *[b["high"] for b in bins]] == edges
    dist = {(r["month"], r["bin"]): r["n"] for r in report.score_distribution(df, "month", "score").collect()}
    seg = {(r["month"], r["bin"]): (r["n"], r["bad"]) for r in report.segment_bad_rate(df, "month", "score", ["fpd7_sx30"]).collect()}
    psi = {r["month"]: r["psi"] for r in report.score_psi(df, "month", "score", "2026-01").collect()}
    base = None
    for month, g in rows.groupby("month"):
        counts = np.histogram(g.score, edges)[0]
        assert [dist[month, i + 1] for i in range(len(counts))] == list(counts) and dist[month, None] == len(g)
        for i in range(len(edges) - 1):
            inside = g[(g.score <= edges[i + 1]) & ((g.score > edges[i]) | (i == 0))]
            assert seg[month, i + 1] == (len(inside), int(inside.fpd7_sx30.sum()))
        p = counts / counts.sum()
        base = p if base is None else base
        want = float(((p - base) * np.log((p + 1e-10) / (base + 1e-10))).sum())
        assert math.isclose(psi[month], want, abs_tol=6e-5)


def test_score_edges_exactly_on_a_bound(spark):
    df = spark.createDataFrame([("m", x, 1.0) for x in (0.0, 0.3, 0.6, 0.7, 1.0)], "month string, s double, y double")
    dist = {r["bin"]: r["n"] for r in report.score_distribution(df, "month", "s").collect()}
    assert [i for i in range(1, 11) if dist[i]] == [1, 4, 7, 8, 10]
    seg = {r["bin"]: r["n"] for r in report.segment_bad_rate(df, "month", "s", ["y"]).collect()}
    assert [i for i in range(1, 11) if seg[i]] == [1, 3, 6, 7, 10]


def test_months_without_scores_stay(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.1), ("b", None)], "month string, s double")
    dist = {(r["month"], r["bin"]): r["n"] for r in report.score_distribution(df, "month", "s").collect()}
    assert dist["b", None] == 0 and dist["a", None] == 2
    assert {r["month"]: r["psi"] for r in report.score_psi(df, "month", "s", "a").collect()} == {"a": 0.0, "b": None}


def test_score_psi_without_base_month_is_null(spark):
    df = spark.createDataFrame([(m, float(i) / 40) for m in ("2026-01", "2026-02") for i in range(40)], "month string, s double")
    assert {r["psi"] for r in report.score_psi(df, "month", "s", "2025-12").collect()} == {None}
    assert {r["month"]: r["psi"] for r in report.score_psi(df, "month", "s", "2026-01").collect()}["2026-01"] == 0.0
