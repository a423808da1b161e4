import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import panel, runs, select


@pytest.fixture(scope="module")
def dev(spark):
    rows = [(f"u{m}_{i}", f"2026-{m:02d}-15", i, float(i % 3 == 0)) for m in range(1, 7) for i in range(100)]
    return spark.createDataFrame(rows, "fuid string, f_p_date string, f1 int, label double")


def test_recent_months_and_weights(spark, dev):
    assert select.recent_n(dev, "f_p_date", 3).count() == 300
    bad = spark.createDataFrame([("x", "junk", 1, 0.0)], dev.schema)
    assert select.recent_n(dev.unionByName(bad), "f_p_date", 6).count() == 600
    with pytest.raises(ValueError):
        select.recent_n(bad, "f_p_date", 1)
    four = dev.where("f_p_date < '2026-05-01'").unionByName(bad)
    w = {r["f_p_date"]: r["w"] for r in select.time_weight(four, "f_p_date").groupBy("f_p_date").agg(F.max("weight").alias("w")).collect()}
    assert np.allclose([w[f"2026-0{m}-15"] for m in (1, 2, 3, 4)], [0.2, 0.2 + 0.8 / 3, 0.2 + 1.6 / 3, 1.0]) and w["junk"] == 1.0
    one = select.time_weight(dev.where("f_p_date = '2026-01-15'"), "f_p_date")
    assert one.agg(F.min("weight")).first()[0] == 1.0


def test_adversarial_drop_and_tiers(spark):
    probabilities = [0.42, 0.07, 0.61, 0.33, 0.07, 0.95, 0.18, 0.77]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(probabilities)], "p double, id int")
    for pct in (0.0, 0.125, 0.25, 0.5, 1.0):
        k = round(len(probabilities) * pct)
        order = sorted(range(len(probabilities)), key=lambda i: (probabilities[i], i))
        assert {r["id"] for r in select.adversarial_drop(df, "p", pct, ["id"]).collect()} == set(order[k:])
    tiers = {0.5: 0.0, 0.6: 0.05, 0.69: 0.05, 0.7: 0.08, 0.8: 0.12, 0.99: 0.12}
    assert {a: select.drop_share(a) for a in tiers} == tiers


def test_adversarial_drop_keeps_rows_without_probability(spark):
    rows = [(None if i % 10 == 0 else float("nan") if i % 10 == 1 else i / 100, i) for i in range(100)]
    df = spark.createDataFrame(rows, "p double, id int")
    kept = {r["id"] for r in select.adversarial_drop(df, "p", 0.1, ["id"]).collect()}
    lowest = [i for p, i in rows if p is not None and p == p][:10]
    assert kept == set(range(100)) - set(lowest)
    assert select.adversarial_drop(df.withColumn("p", F.lit(None).cast("double")), "p", 0.5, ["id"]).count() == 100


def test_strata_are_label_values(spark):
    rows = [(i, [-1.0, None, 0.25, 0.75][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, y double")
    got = select.stratified_split(df, "y", ["id"]).groupBy("y", "part").count().collect()
    assert {(r["y"], r["part"], r["count"]) for r in got} == {(y, p, n) for y in (-1.0, None, 0.25, 0.75) for p, n in (("train", 70), ("val", 30))}
    text = select.stratified_split(df.withColumn("y", F.col("y").cast("string")), "y", ["id"])
    assert text.where("part = 'train'").count() == 280


def test_importance_cut(spark):
    gains = {"w": 45.0, "x": 25.0, "y": 20.0, "z": 10.0}
    imp = spark.createDataFrame(list(gains.items()), "feature string, total_gain double")
    assert {r["feature"] for r in select.importance_cut(imp, 70.0).collect()} == {"w", "x", "y"}
    assert {r["feature"] for r in select.importance_cut(imp, 69.0).collect()} == {"w", "x"}
    names = imp.select("feature")
    assert {r["feature"] for r in select.adversarial_features(imp, names, 3).collect()} == {"z"}
    assert select.importance_cut(imp.withColumn("total_gain", F.lit(0.0))).count() == 4


def test_absent_features_are_kept(spark):
    dev = spark.createDataFrame([(float(i), float(i % 2)) for i in range(100)], "a double, y double")
    got = {r["feature"]: r for r in select.iv_psi_filter(dev, dev, ["a", "gone"], "y").collect()}
    assert got["gone"]["kept"] and got["gone"]["iv"] is None and len(got) == 2


def test_leaderboard_uses_whole_ids_and_treats_nan_as_missing(spark):
    from riskspark.operators import runs

    rows = [("x" * 60 + c, 0.7) for c in "cab"] + [("nan", float("nan")), ("null", None), ("best", 0.9)]
    df = spark.createDataFrame(rows, "run string, oot_auc double")
    board = {r["rank"]: r["run"] for r in runs.leaderboard(df).collect()}
    assert [board[k][-4:] for k in range(1, 7)] == ["best", "xxxa", "xxxb", "xxxc", "nan", "null"]
    assert [r["run"] for r in runs.top_runs(df, 1).collect()] == ["best"]
    assert runs.top_runs(df, 10).count() == 4 and runs.top_runs(df, 10, done=F.lit(True)).count() == 6
    assert runs.best_per_algo(df.withColumn("algo", F.lit("a"))).first()["run"] == "best"


def test_nan_is_null_for_iv_and_no_forced_broadcast(spark, monkeypatch):
    from riskspark.operators import iv

    y = [float(i % 3 == 0) for i in range(300)]
    frames = [
        spark.createDataFrame([(g if i % 7 == 0 else float(i % 50), y[i], i % 40) for i in range(300)], "f double, y double, user int")
        for g in (None, float("nan"))
    ]
    a, b = (iv.feature_iv(d, "y", ["f"]).first()["iv"] for d in frames)
    assert a == b
    from riskspark.operators import bins

    small = iv.woe_table(frames[0], "y", ["f"], keys=["user"], n_bins=2)
    monkeypatch.setattr(bins, "BROADCAST_NUMBERS", 100)
    large = iv.woe_table(frames[0], "y", ["f"], keys=["user"], n_bins=2)
    hints = ["strategy=broadcast" in d._jdf.queryExecution().optimizedPlan().toString() for d in (small, large)]
    assert hints == [True, False] and small.exceptAll(large).isEmpty()


def test_iv_psi_filter(spark):
    rng = np.random.default_rng(42)
    n = 2000
    y = (rng.random(n) < 0.2).astype(float)
    rows = [
        (float(y[i] * 2 + g), float(v), float(v2 + 50 * (i >= 1000)), float(m) if i % 50 == 0 else None, float(y[i]))
        for i, (g, v, v2, m) in enumerate(zip(rng.normal(size=n), rng.normal(size=n), rng.normal(size=n) + y, rng.normal(size=n)))
    ]
    dev = spark.createDataFrame(rows, "good double, iv_low double, psi_high double, missing double, y double")
    oot = dev.withColumn("psi_high", F.col("psi_high") + 50)
    got = {r["feature"]: r for r in select.iv_psi_filter(dev, oot, ["good", "iv_low", "psi_high", "missing"], "y", iv_floor=0.1).collect()}
    assert {f for f in got if got[f]["kept"]} == {"good"}
    assert got["missing"]["missing_rate"] >= 0.95 and got["psi_high"]["psi"] > 0.2 and got["good"]["psi"] == 0.0


def test_safety_filter_reasons(spark):
    rows = [(i, float(i % 2), float(i % 2), 5.0, float(i % 7), 100.0 * (i % 2) + i % 3 * 0.01, None if i else 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y double, copy double, const double, ok double, near double, one double")
    features = ["id", "gone", "copy", "const", "ok", "near", "one"]
    got = {r["feature"]: r["reason"] for r in select.safety_filter(df, features, "id", "y").collect()}
    assert got == {"id": "id_col", "gone": "missing_column", "copy": "leak_equal", "const": "constant", "ok": None,
                   "near": "leak_high_corr", "one": "constant"}


def test_stratified_split_is_exact_and_reproducible(spark, dev):
    wide = dev.withColumn("label", F.when(F.col("f1") < 90, F.col("label")))
    tagged = select.stratified_split(wide, "label", ["fuid"])
    counts = {(r["label"], r["part"]): r["count"] for r in tagged.groupBy("label", "part").count().collect()}
    totals = {r["label"]: r["count"] for r in wide.groupBy("label").count().collect()}
    for y, n in totals.items():
        assert counts[y, "train"] == round(n * 0.7) and counts[y, "train"] + counts[y, "val"] == n
    again = select.stratified_split(wide.repartition(5), "label", ["fuid"])
    assert tagged.select("fuid", "part").exceptAll(again.select("fuid", "part")).isEmpty()
    single = wide.limit(50).unionByName(spark.createDataFrame([("solo", "2026-01-15", 1, 7.0)], wide.schema))
    assert select.stratified_split(single, "label", ["fuid"]).where("part = 'train'").count() == round(51 * 0.7)


def test_stratified_split_does_not_deal_rows_by_label(spark):
    df = spark.range(4000, numPartitions=8).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tagged = select.stratified_split(df, "y", ["id"])
        sizes = [r["count"] for r in tagged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) <= 600


def test_negative_downsample(spark, dev):
    rows = dev.withColumn("y", (F.col("f1") == 0).cast("int"))
    kept = select.negative_downsample(rows, "y", 8, ["fuid"])
    assert {r["y"]: r["count"] for r in kept.groupBy("y").count().collect()} == {1: 6, 0: 48}
    assert select.negative_downsample(rows, "y", 1000, ["fuid"]).count() == 600


def test_panel(spark):
    a = spark.createDataFrame([("u", 1, 0.1), ("u", 2, 0.2)], "uid string, d int, s1 double")
    b = spark.createDataFrame([("u", 1, 0.3), ("u", 2, 0.4)], "uid string, d int, s2 double")
    assert panel.score_join(a, b, ["uid", "d"]).count() == 2
    with pytest.raises(ValueError):
        panel.score_join(a, b, ["uid"])
    with pytest.raises(ValueError):
        panel.score_join(a, b.unionAll(b), ["uid", "d"])
    p = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 1, 0), ("b", 2, 1), ("c", 1, 1)], "u string, m int, y int")
    r = panel.panel_stickiness(p, "u", "m", "y").first()
    assert (r["users"], r["multi_period_users"], r["constant_label_users"], r["constant_share"]) == (3, 2, 1, 0.5)


def test_runs(spark):
    rows = [("r1", "lgb", 0.80, 0.70), ("r2", "xgb", 0.72, 0.715), ("r3", "lgb", 0.75, 0.75), ("r10", "xgb", 0.72, None), ("r0", "xgb", 0.69, 0.66), ("r4", "lgb", 0.74, 0.715)]
    t = spark.createDataFrame(rows, "run string, algo string, train_auc double, oot_auc double")
    order = [r["run"] for r in runs.leaderboard(t).orderBy("rank").collect()]
    assert order == ["r3", "r2", "r4", "r1", "r0", "r10"]
    assert {r["algo"]: r["run"] for r in runs.best_per_algo(t).collect()} == {"lgb": "r3", "xgb": "r2"}
    assert [r["run"] for r in runs.top_runs(t, 2).collect()] == ["r3", "r2"]
    d = t.withColumns({"it": F.when(F.col("run") == "r4", 990).otherwise(100), "n": F.lit(1000), "psi": F.when(F.col("run") == "r2", 0.3).otherwise(0.01)})
    got = {r["run"]: (r["status"], r["reasons"]) for r in runs.diagnose_runs(d, best_iter="it", n_estimators="n", psi="psi").collect()}
    assert got["r1"] == ("overfit", "overfit") and got["r3"][0] == "underfit" and got["r4"] == ("underconverged", "underconverged")
    assert got["r2"] == ("unstable_psi", "unstable_psi") and got["r0"][0] == "underfit" and got["r10"] == ("well_fit", "")
    rep = spark.createDataFrame([("r1", 0.7), ("r2", 0.8), ("rx", 0.1)], "run string, value double")
    com = spark.createDataFrame([("r1", 0.7004), ("r2", 0.7)], "run string, value double")
    assert {r["run"]: r["status"] for r in runs.metric_reconcile(rep, com, ["run"]).collect()} == {"r1": "ok", "r2": "differs", "rx": "not_computed"}
