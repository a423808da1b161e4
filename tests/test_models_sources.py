import json
import math
import warnings

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskspark.functions import scores
from riskspark.operators import models, quality, scorecard
from riskspark.plans.flows import deliver_scores
from riskspark.sources import evaluations, samples, staging

FAST = {"maxIter": 5, "maxDepth": 3, "minInstancesPerNode": 1}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(800):
        x, noise = rng.normal(), rng.normal()
        rows.append((f"u{i}", 20260101 + i % 28, None if i % 10 == 0 else float(x), float(noise), float(x + 0.3 * noise > 0)))
    return spark.createDataFrame(rows, "fuid string, f_p_date int, f0 double, f1 double, label double").cache()


@pytest.fixture(scope="module")
def model(data):
    train, val = data.where("f_p_date < 20260121"), data.where("f_p_date >= 20260121")
    return models.train_model(train, val, ["f0", "f1"], "label", params=FAST)


def test_training_scoring_and_saving(spark, data, model, tmp_path):
    scored = models.score_rows(data, model)
    assert scored.columns == ["fuid", "f_p_date", "label", "score"]
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low < high <= 1
    assert quality.auc(scored, "score", "label").first()["auc"] > 0.9
    imp = models.importance_table(model).collect()
    assert imp[0]["feature"] == "f0" and math.isclose(sum(r["gain_pct"] for r in imp), 100, abs_tol=0.01)
    with pytest.raises(ValueError):
        models.score_rows(data.drop("f1"), model)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = models.score_rows(data, PipelineModel.load(str(tmp_path / "m")))
    assert scored.exceptAll(again).isEmpty()


def test_delivery_needs_no_label(data, model):
    fresh = data.drop("label").withColumn("f0", F.when(F.col("f_p_date") % 5 == 0, -1.0).otherwise(F.col("f0")))
    out = deliver_scores(fresh, model, calibration=(2.0, -3.0))
    assert out.columns == ["fuid", "f_p_date", "score", "odds", "logistic_prob", "bscore"] and out.count() == 800


def test_adversarial_and_tuning(data, model):
    shifted = data.withColumn("f0", F.col("f0") + 3)
    _, imp, auc = models.train_adversarial(data, shifted, ["f0", "f1"], ["fuid", "f_p_date"], FAST)
    assert auc > 0.8 and imp.count() == 2
    train, val = data.where("f_p_date < 20260121"), data.where("f_p_date >= 20260121")
    _, best, trials = models.tune_model(train, val, ["f0", "f1"], "label", [FAST, {**FAST, "maxDepth": 1}])
    assert len(trials) == 2 and dict(best) == max(trials, key=lambda t: t[1])[0]


def newton(p, y, strength=20.0):
    x = np.log(p / (1 - p))
    b = np.zeros(2)
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        q = 1 / (1 + np.exp(-design @ b))
        grad = strength * design.T @ (q - y) + np.array([b[0], 0])
        hess = strength * (design.T * (q * (1 - q))) @ design + np.diag([1.0, 0.0])
        b -= np.linalg.solve(hess, grad)
    return b


def test_scorecard(spark):
    rng = np.random.default_rng(42)
    p = np.clip(rng.beta(2, 8, 2000), 0.001, 0.999)
    y = (rng.random(2000) < p).astype(float)
    df = spark.createDataFrame([*zip(p.tolist(), y.tolist()), (0.5, None)], "score double, label double")
    coef, intercept = scorecard.fit_calibration(df, "score", "label")
    assert np.allclose([coef, intercept], newton(p, y), atol=1e-4) and coef > 0
    card = scorecard.apply_scorecard(df, "score", coef, intercept)
    s = scorecard.scorecard_summary(card).first()
    assert s["n"] == 2001 and s["below_range"] + s["above_range"] < 0.1 * 2001 and s["not_finite"] == 0
    with pytest.raises(ValueError):
        scorecard.fit_calibration(df, "score", "gone")
    with pytest.raises(ValueError):
        scorecard.fit_calibration(df.where("label is null"), "score", "label")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        scorecard.fit_calibration(df.withColumn("label", 1 - F.col("label")), "score", "label")
    assert caught
    r = spark.range(1).select(
        scores.scorecard_points(F.lit(0.5)).alias("a"), scores.log_odds(F.lit(0.0)).alias("b"),
        scores.log_odds(F.lit(None).cast("double")).alias("c"),
    ).first()
    assert r["a"] == 400 and math.isclose(r["b"], math.log(1e-6 / (1 - 1e-6))) and r["c"] is None


def test_rowwise_operators_accept_a_stream(spark, data, tmp_path):
    from riskspark.operators.clean import sentinel_replace

    path = str(tmp_path / "in")
    data.select("fuid", F.abs("f1").alias("f1")).write.parquet(path)
    stream = spark.readStream.schema("fuid string, f1 double").parquet(path)
    out = scorecard.apply_scorecard(sentinel_replace(stream, ["f1"], [0.5]), "f1", 1.0, 0.0)
    q = out.writeStream.format("memory").queryName("cards").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("cards").count() == 800


def test_outline_sees_every_row(spark):
    """The last month comes in the last rows, after a candidate column without dates."""
    df = spark.range(40_000).select(
        F.lit("n/a").alias("ser_no"),
        F.when(F.col("id") < 39_990, "2020-01-03").when(F.col("id") == 39_999, "junk").otherwise("2021-02-28").alias("order_date"),
    )
    assert samples.outline_sample(df).months == ("2020-01", "2021-02")
    assert samples.outline_sample(df.select("ser_no")).date is None
    assert samples.outline_sample(df.limit(0)).months == ()


def test_medians_and_balance_come_from_training_rows(spark):
    train = spark.createDataFrame([(1.0, 0.0), (3.0, 1.0), (None, 0.0)], "f double, y double")
    val = spark.createDataFrame([(1000.0, 1.0)] * 9, "f double, y double")
    rows = models._training_rows(train, val, ["f"], "y", None).cache()
    vectors, (imputer, _) = models._assembled(rows, ["f"])
    assert imputer.surrogateDF.first()["f"] < 10
    assert {r["__w"] for r in vectors.where("__y = 1").collect()} == {2.0}


def test_tuning_reads_its_tables_once(spark, data, tmp_path, monkeypatch):
    from riskspark.sources import staging as st

    monkeypatch.setattr(st, "staging_dir", lambda _: str(tmp_path))
    train, val = data.where("f_p_date < 20260121"), data.where("f_p_date >= 20260121")
    models.tune_model(train, val, ["f0", "f1"], "label", [FAST, {**FAST, "maxDepth": 1}, {**FAST, "maxDepth": 2}])
    assert not [p for p in tmp_path.iterdir() if not p.name.startswith(".")]
    grid = models.neighbourhood()
    assert len(grid) == 9 and len({(g["maxDepth"], g["stepSize"]) for g in grid}) == 9


def test_cell(spark, data):
    from riskspark.plans.flows import run_cell

    parts = [data.where(c) for c in ("f_p_date < 20260115", "f_p_date between 20260115 and 20260121", "f_p_date > 20260121")]
    cell = run_cell(*parts, ["f0", "f1"], "label", "r1", params=FAST)
    row = cell.row.first()
    assert (row["run"], row["n_features"]) == ("r1", 2) and row["train_n"] + row["val_n"] + row["oot_n"] == 800
    assert row["oot_auc"] > 0.9 and row["psi_oot"] is not None
    assert {r["split"] for r in cell.evaluation.collect()} == {"train", "val", "oot", "all"}


def test_sources(spark, tmp_path):
    csv = tmp_path / "s.csv"
    csv.write_text("fuid,fser_date,score_a,fpd7_x\nu1,2026-01-05,0.1,1\nu2,2026-02-05,0.2,0\n")
    df = samples.read_sample(spark, str(csv))
    assert samples.read_sample_columns(spark, str(csv)) == ["fuid", "fser_date", "score_a", "fpd7_x"]
    o = samples.outline_sample(df)
    assert (o.date, o.months, o.labels, o.scores) == ("fser_date", ("2026-01", "2026-02"), ("fpd7_x",), ("score_a",))
    target = str(tmp_path / "s.parquet")
    assert samples.convert_to_parquet(spark, str(csv), target).count() == 2
    assert samples.read_sample_columns(spark, target) == df.columns
    (tmp_path / "s.json").write_text('[{"a": 1}, {"a": 2}]')
    assert samples.read_sample(spark, str(tmp_path / "s.json")).count() == 2
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    samples.write_sample(nan, str(tmp_path / "n.parquet"))
    assert samples.read_sample(spark, str(tmp_path / "n.parquet")).where("x is null").count() == 1
    samples.write_sample(df.withColumn("month", F.date_format("fser_date", "yyyy-MM")), str(tmp_path / "m.parquet"), "month")
    assert samples.read_sample(spark, str(tmp_path / "m.parquet")).where("month = '2026-01'").count() == 1
    samples.write_feature_list(spark, ["a", "b", "a"], str(tmp_path / "f.csv"))
    assert samples.read_feature_list(spark, str(tmp_path / "f.csv")) == ["a", "b"]
    (tmp_path / "f.txt").write_text("# c\na\n\nb\n")
    assert samples.read_feature_list(spark, str(tmp_path / "f.txt")) == ["a", "b"]
    with pytest.raises(ValueError):
        samples.read_sample(spark, "x.feather")
    staged = staging.stage(df)
    assert staged.exceptAll(df).isEmpty() and staged.schema == df.schema


def test_fits_read_even_parts_of_the_rows(spark, monkeypatch):
    rows = spark.range(1000, numPartitions=1).select((F.col("id") % 2).alias("y"), (F.col("id") * 7 % 11).cast("double").alias("f"))
    sizes = []

    def boost(vectors, params, seed, real=models._boost):
        sizes.append([r["count"] for r in vectors.groupBy(F.spark_partition_id().alias("p")).count().collect()])
        return real(vectors, params, seed)

    monkeypatch.setattr(models, "TASK_ROWS", 50, raising=False)
    monkeypatch.setattr(models, "_boost", boost)
    small = {"maxIter": 1, "maxDepth": 2}
    models.train_model(rows, rows, ["f"], "y", params=small)
    models.tune_model(rows, rows, ["f"], "y", [small])
    models.halving_search(rows, rows, ["f"], "y", [{**models.DEFAULT_PARAMS, **small}])
    assert len(sizes) >= 3
    assert all(sum(s) == 2000 and max(s) <= 60 for s in sizes)


def test_large_tables_are_fitted_in_blocks_of_equal_bins(spark, monkeypatch):
    """Fits get about ``FIT_ROWS`` blocks however many rows there are; no row or weight is lost, and scores hold on all rows."""
    n = 6000
    rows = spark.range(n).select(
        "id", (F.col("id") % 5).cast("double").alias("few"), F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 1009).cast("double")).alias("many"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") * 37 % 1009 > 504, 8).otherwise(2)).cast("double").alias("y"),
    )
    train, val = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    seen = []

    def boost(vectors, params, seed, real=models._boost):
        seen.append(vectors.groupBy("__val").agg(F.count("*").alias("n"), F.sum("__w").alias("w")).collect())
        return real(vectors, params, seed)

    monkeypatch.setattr(models, "FIT_ROWS", 400, raising=False)
    monkeypatch.setattr(models, "_boost", boost)
    model, best, trials = models.tune_model(train, val, ["few", "many"], "y", [FAST, {**FAST, "maxDepth": 1}])
    p, m = train.where("y = 1").count(), train.count()
    weight = {False: 2.0 * (m - p), True: val.where("y = 0").count() + val.where("y = 1").count() * (m - p) / p}
    for r in seen[0]:
        assert math.isclose(r["w"], weight[r["__val"]], rel_tol=1e-9)
        assert r["n"] <= 400 + 2 * 2 * 5 * 33
    assert len(seen) == 2 and sum(r["n"] for r in seen[0]) < n / 3
    scored = models.score_rows(val, model)
    auc = quality.auc(scored, "score", "y").first()["auc"]
    assert auc > 0.7 and math.isclose(auc, max(t[1] for t in trials), rel_tol=1e-9)
    compiled = {r["id"]: r["score"] for r in deliver_scores(rows, model, []).collect()}
    assert all(math.isclose(r["score"], compiled[r["id"]], rel_tol=1e-12) for r in models.score_rows(rows, model).collect())


def test_collect_evaluations(spark, tmp_path):
    for run, auc in (("a-1", 0.6), ("b 2", 0.7)):
        d = tmp_path / run / "evaluation"
        d.mkdir(parents=True)
        payload = {"splits": {"oot": {"auc": auc, "n": 10}, "val": {"auc": 0.65, "n": 5}}, "algo": "gbt", "features": 3, "optimistic_bias": auc > 0.65}
        (d / "eval.json").write_text(json.dumps(payload))
    got = evaluations.collect_evaluations(spark, str(tmp_path / "*" / "evaluation" / "eval.json"))
    rows = {r["run"]: r for r in got.collect()}
    assert rows["b 2"]["oot_auc"] == 0.7 and rows["b 2"]["optimistic_bias"] and rows["a-1"]["val_n"] == 5
    specs = spark.createDataFrame([("a-1", "gbt", "done"), ("c", "gbt", "failed"), ("d", "gbt", "done")], "run string, algo string, status string")
    status = {r["run"]: r["status"] for r in evaluations.join_run_specs(specs, got).collect()}
    assert status == {"a-1": "done", "c": "failed", "d": "missing_eval"}


def test_collect_evaluations_of_a_folder(spark, tmp_path):
    for run, auc in (("a-1", 0.6), ("b 2", 0.7)):
        d = tmp_path / run / "evaluation"
        d.mkdir(parents=True)
        (d / "eval.json").write_text(json.dumps({"splits": {"oot": {"auc": auc}}, "algo": "gbt"}))
        (d / "notes.txt").write_text("{")
    got = evaluations.collect_evaluations(spark, str(tmp_path))
    assert sorted((r["run"], r["oot_auc"]) for r in got.collect()) == [("a-1", 0.6), ("b 2", 0.7)]


def test_evaluation_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from registry import QUERIES, load, q_sources

    load()
    monkeypatch.setattr(q_sources, "_folder", lambda spark: str(tmp_path / "runs"))
    rows = QUERIES["evaluation_files"](spark, "/root/testdata/sf0.001").count()
    files = [f.name for f in (tmp_path / "runs").glob("*/*/*.json")]
    assert len(files) == rows and len({f[:10] for f in files}) > 1


def test_summary_computes_points_once(spark):
    df = spark.createDataFrame([(0.1,), (0.4,), (None,)], "p double")
    summary = scorecard.scorecard_summary(scorecard.apply_scorecard(df, "p", 1.2, -0.3))
    assert "log(" not in summary._jdf.queryExecution().optimizedPlan().toString().lower()
    assert summary.first()["n"] == 3 and summary.first()["not_finite"] == 1


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {"feature", "month", "psi", "iv"} <= set(e.entry(spark).columns)


def test_trials_of_large_tables_judge_one_row_for_all_with_equal_bins(spark, monkeypatch):
    rows = spark.range(6000).select(
        "id", (F.col("id") % 5).cast("double").alias("few"), F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 101).cast("double")).alias("many"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") * 37 % 101 > 50, 8).otherwise(2)).cast("double").alias("y"),
    )
    train, val = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    judged = []

    def metrics(df, score, label, keys=(), real=models.rank_metrics, **times):
        judged.append((df.count(), df))
        return real(df, score, label, keys, **times)

    monkeypatch.setattr(models, "FIT_ROWS", 400, raising=False)
    monkeypatch.setattr(models, "rank_metrics", metrics)
    model, _, trials = models.tune_model(train, val, ["few", "many"], "y", [FAST])
    assert judged[0][0] <= 2 * 5 * 34 < val.count() / 2
    row = quality.rank_metrics(models.score_rows(val, model), "score", "y").first()
    assert math.isclose(trials[0][1], row["auc"], rel_tol=1e-9)
