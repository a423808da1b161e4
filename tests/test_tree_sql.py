"""Compiled trees against the vector model, and the search over parameter sets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import models, quality, tree_sql
from riskspark.plans.flows import deliver_scores

SMALL = {"maxIter": 6, "maxDepth": 4, "minInstancesPerNode": 1}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        x, z = rng.normal(), rng.normal()
        gone = rng.random() < 0.15
        y = float(x + 0.4 * z + (1.2 if gone else 0) > 0.3)
        rows.append((i, float("nan") if gone and i % 2 else None if gone else float(x), str(round(float(z), 4)) if i % 9 else "n/a", int(rng.integers(0, 4)), y))
    return spark.createDataFrame(rows, "id long, f0 double, `f 1` string, f2 int, y double").cache()


FEATURES = ["f0", "f 1", "f2"]


@pytest.fixture(scope="module")
def model(data):
    return models.train_model(data.where("id % 3 > 0"), data.where("id % 3 = 0"), FEATURES, "y", params=SMALL)


def test_sql_scores_equal_the_vector_scores_on_all_rows(data, model):
    want = {r["id"]: r["score"] for r in models.score_rows(data, model).collect()}
    out = tree_sql.score_with_sql(data, model)
    assert out.columns == ["id", "y", "score"]
    got = {r["id"]: r["score"] for r in out.collect()}
    assert set(got) == set(want) and all(math.isclose(got[i], want[i], rel_tol=1e-12) for i in want)
    assert len(set(got.values())) > 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_several_models_in_one_pass(data, model):
    other = models.train_model(data.where("id % 3 > 0"), data.where("id % 3 = 0"), ["f0"], "y", params={**SMALL, "maxDepth": 1})
    both = tree_sql.score_with_sql(data, {"a": model, "b": other})
    assert both.columns == ["id", "y", "a", "b"]
    for name, m in (("a", model), ("b", other)):
        want = {r["id"]: r["score"] for r in models.score_rows(data, m).collect()}
        assert all(math.isclose(r[name], want[r["id"]], rel_tol=1e-12) for r in both.collect())


def test_an_empty_table_and_a_missing_feature(data, model):
    assert tree_sql.score_with_sql(data.where("id < 0"), model).count() == 0
    with pytest.raises(ValueError):
        tree_sql.score_with_sql(data.drop("f2"), model)


def test_delivered_scores_separate_and_points_follow(data, model):
    out = deliver_scores(data, model, sentinels=[], calibration=(2.0, -3.0))
    assert quality.auc(out, "score", "y").first()["auc"] > 0.85  # a constant score has 0.5
    rows = out.orderBy("score").select("score", "bscore").collect()
    assert rows[0]["bscore"] > rows[-1]["bscore"] or rows[0]["bscore"] < rows[-1]["bscore"]
    direction = 1 if rows[0]["bscore"] < rows[-1]["bscore"] else -1
    assert all(direction * (b["bscore"] - a["bscore"]) >= 0 for a, b in zip(rows, rows[1:]))
    constant = data.withColumn("score", F.lit(0.5))
    assert quality.auc(constant, "score", "y").first()["auc"] == 0.5


def test_halving_reports_every_trial_and_keeps_the_best(data):
    train, val = data.where("id % 3 > 0"), data.where("id % 3 = 0")
    trials = [{**p, "maxIter": 4, "minInstancesPerNode": 1} for p in models.sampled_trials(6, seed=3, start={"maxDepth": 3})]
    model, best, report = models.halving_search(train, val, FEATURES, "y", trials, rungs=((1, 3), (2, 2), (None, 1)))
    assert [r["trial"] for r in report] == list(range(6)) and all(0 <= r["auc"] <= 1 for r in report)
    assert sorted(r["rounds"] for r in report) == [1, 1, 1, 2, 4, 4]
    last = [r for r in report if r["rounds"] == 4]
    top = max(last, key=lambda r: (r["auc"], -r["trial"]))
    assert best == trials[top["trial"]]
    auc = quality.auc(models.score_rows(val, model), "score", "y").first()["auc"]
    assert math.isclose(auc, top["auc"], rel_tol=1e-9) and auc > 0.7


def test_sampled_trials_are_reproducible():
    first, again = models.sampled_trials(), models.sampled_trials()
    assert first == again and len(first) == 25 and len({tuple(sorted(p.items())) for p in first}) == 25
