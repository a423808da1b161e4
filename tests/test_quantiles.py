"""Quantiles by sketched brackets, and the cube of bin counts, against numpy and the single operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import feature_cube, iv, quantiles, select, stability
from riskspark.operators.quantiles import exact_quantiles, quantiles_by_purpose

PS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


def values(seed: int, n: int) -> list[float]:
    r = random.Random(seed)
    kinds = [lambda: r.gauss(0, 1), lambda: float(r.randint(0, 5)), lambda: 1.7e9 + r.random(), lambda: r.lognormvariate(0, 6)]
    kind = r.choice(kinds)
    return [kind() for _ in range(n)]


def close(got: list[float], want: np.ndarray) -> bool:
    return np.allclose(got, want, rtol=1e-12, atol=0)


def test_many_groups_of_all_sizes(spark):
    data = {i: values(i, n) for i, n in enumerate([1, 2, 3, 9, 50, 400, 5000, 20000] * 3)}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [(99, None)], "k int, v double").repartition(5)
    got = {r["k"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["k"], "v", PS).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k][0] == len(vs) and close(got[k][1], np.quantile(vs, PS))


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_sketches", wrong(quantiles._sketches))
    vs = values(3, 3000)
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vs)], "k int, v double")
    for r in exact_quantiles(df, ["k"], "v", PS, 2).collect():
        assert close(r["q"], np.quantile(vs[r["k"] :: 2], PS))


def wrong(sketches):
    """Brackets shrunk to one value far from the wanted rank, for one of two groups."""

    def broken(rows, keys, value, probabilities, purposes):
        table = sketches(rows, keys, value, probabilities, purposes)
        off = F.when(F.col("__k") == 1, F.transform("lo0", lambda _: F.get("lo0", F.lit(1))))
        return table.withColumns({"lo0": F.coalesce(off, "lo0"), "hi0": F.coalesce(off, "hi0")})

    return broken


def test_purposes_share_the_passes(spark):
    r = random.Random(5)
    rows = [(r.choice("ab"), r.random() < 0.4, r.gauss(0, 3) if r.random() < 0.9 else None) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, y boolean, v double")
    got = quantiles_by_purpose(df, ["k"], "v", PS, {"all": F.lit(True), "some": F.col("y"), "none": F.lit(False)}).collect()
    assert {(x["k"], x["purpose"]) for x in got} == {(k, p) for k in "ab" for p in ("all", "some")}
    for x in got:
        vs = [v for k, y, v in rows if k == x["k"] and v is not None and (y or x["purpose"] == "all")]
        assert x["n"] == len(vs) and close(x["q"], np.quantile(vs, PS))


def test_more_groups_than_ranges_and_what_is_kept(spark):
    """6,000 groups, one of them hot: what stays of the hot group is a few brackets' worth, and no bracket holds it whole."""
    hot = spark.range(200_000).select(F.lit(-1).alias("k"), F.rand(3).alias("v"))
    cold = spark.range(60_000).select((F.col("id") % 6000).cast("int").alias("k"), F.rand(4).alias("v"))
    df = hot.unionByName(cold)
    brackets = quantiles._sketches(df, ["k"], "v", [0.5, 0.9], {"all": F.lit(True)})
    cells = quantiles._cells(df, ["k"], "v", 2, {"all": F.lit(True)}, brackets).where("k = -1")
    kept = cells.where("seg % 2 = 1").groupBy("seg").agg(F.sum("c").alias("n")).collect()
    assert len(kept) == 2 and max(x["n"] for x in kept) < 2_000
    assert cells.where("seg % 2 = 0").count() <= 3 and cells.agg(F.sum("c")).first()[0] == 200_000
    assert exact_quantiles(df, ["k"], "v", [0.5]).count() == 6001


def test_without_keys_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    row = exact_quantiles(df, [], "v", [0.25, 0.5]).first()
    assert (row["n"], row["q"]) == (11, [2.5, 5.0])
    assert exact_quantiles(df.where("v < 0"), [], "v", [0.5]).count() == 0
    assert exact_quantiles(df.where("v < 0").withColumn("k", F.lit(1)), ["k"], "v", [0.5]).count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    r = random.Random(11)
    rows = []
    for i in range(3000):
        month = r.choice(["2026-01", "2026-02", "2026-03", None])
        y = r.choice([0.0, 1.0, None])
        shift = 0.4 if month == "2026-03" else 0.0
        rows.append((month, y, r.gauss(shift + (y or 0), 1) if r.random() < 0.9 else None, float(r.randint(0, 4)), 7.0 if i % 50 else float("nan"), None))
    return spark.createDataFrame(rows, "month string, y double, f0 double, f1 double, f2 double, f3 double")


FEATURES = ["f0", "f1", "f2", "f3"]


def same(a, b) -> bool:
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))


def test_stability_equals_the_single_operators(sample):
    psi = {(r["feature"], r["month"]): (r["n"], r["psi"]) for r in stability.monthly_psi(sample, "month", FEATURES, "2026-01").collect()}
    ivs = {(r["feature"], r["month"]): r["iv"] for r in iv.monthly_iv(sample, "y", FEATURES, "month").collect()}
    got = feature_cube.feature_stability(sample, "y", "month", FEATURES, "2026-01").collect()
    assert {(r["feature"], r["month"]) for r in got} == set(psi)
    for r in got:
        key = r["feature"], r["month"]
        assert r["n"] == psi[key][0] and same(r["psi"], psi[key][1]) and same(r["iv"], ivs.get(key))


def test_filter_equals_the_single_operators(sample):
    dev, oot = sample.where("month < '2026-03'"), sample.where("month = '2026-03'")
    ivs = {r["feature"]: r["iv"] for r in iv.feature_iv(dev, "y", FEATURES).collect()}
    psi = {r["feature"]: r["psi"] for r in stability.feature_psi(dev, oot, FEATURES).collect()}
    total = dev.count()
    got = {r["feature"]: r for r in feature_cube.missing_iv_psi(dev, oot, FEATURES, "y").collect()}
    assert set(got) == set(FEATURES)
    for f, r in got.items():
        held = dev.where(F.col(f).isNotNull() & ~F.isnan(f)).count()
        assert same(r["missing_rate"], 1 - held / total) and same(r["iv"], ivs.get(f)) and same(r["psi"], psi.get(f))
    kept = {r["feature"]: r["kept"] for r in select.iv_psi_filter(dev, oot, FEATURES, "y").collect()}
    assert kept["f0"] and not kept["f3"]
