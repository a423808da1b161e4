"""Rank selection and running totals against brute force, with hot keys and hot values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators.quantiles import exact_quantiles
from riskspark.operators.ranks import rank_threshold, ranked, running_totals


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    rows = []
    for _ in range(6000):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        value = 0.0 if rng.random() < 0.35 else round(rng.lognormvariate(0, 3), 3)
        rows.append((key, value))
    return rows


def test_quantiles_match_numpy_on_skew(spark, skewed):
    ps = [0.0, 0.1, 0.3, 0.5, 0.77, 0.99, 1.0]
    df = spark.createDataFrame([*skewed, ("empty", None)], "k string, v double")
    got = {r["k"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["k"], "v", ps).collect()}
    assert "empty" not in got
    for key in ("hot", "a", "b", None):
        values = [v for k, v in skewed if k == key]
        assert got[key][0] == len(values)
        assert np.allclose(got[key][1], np.quantile(values, ps), rtol=1e-12, atol=0)


def test_running_totals_match_loop(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, v double")
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"), F.sum(F.lit(2)).alias("d"))
    rows = running_totals(counts, ["k"], ["v"], ["c", "d"]).collect()
    for key in ("hot", "a", "b", None):
        mine = sorted((r for r in rows if r["k"] == key), key=lambda r: r["v"])
        before = 0
        for r in mine:
            assert (r["before_c"], r["before_d"]) == (before, 2 * before)
            before += r["c"]
        assert {r["total_c"] for r in mine} == {before}


def test_composite_order_and_global_rank(spark):
    rows = [(i % 5, -i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, id long")
    got = {r["id"]: r["rank"] for r in ranked(df, [], ["a", "b"]).collect()}
    want = {r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1])))}
    assert got == want


def test_threshold_outside_the_group_is_null(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 9)], "k int, v long")
    cut = {r["k"]: r["cut"] for r in rank_threshold(df, ["k"], ["v"], F.lit(1)).collect()}
    assert cut.get(1)["v"] == 7 and cut.get(2) is None


def test_plan_has_no_cartesian_or_single_partition_sort(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, v double")
    plan = exact_quantiles(df, ["k"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
