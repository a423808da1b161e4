"""Score-card, model training and scoring, run tables. A run here is one supplier's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from registry import query
from registry.base import FEATURES, S, SPLIT_TAG, SPLITS, rank_sql, rounded, sample, sql_round, table
from riskspark.functions.scores import POINTS_FACTOR
from riskspark.functions.values import label_family
from riskspark.operators import models, project, quality, runs, scorecard, select, stability
from riskspark.plans.flows import deliver_scores, run_cell
from riskspark.sources.staging import stage

COEF, INTERCEPT = 1.2, -0.3
OOT_DAYS = "dt BETWEEN DATE '2000-01-01' AND DATE '2001-11-30'"


def _odds(p: str) -> str:
    c = f"greatest(1e-6, least(1 - 1e-6, {p}))"
    return f"ln({c} / (1 - {c}))"


CARD = f"""{S}, o AS (SELECT *, CASE WHEN score_old IS NOT NULL THEN {_odds('score_old')} END AS odds FROM s),
  c AS (SELECT *, CASE WHEN odds IS NOT NULL THEN 1 / (1 + exp(-greatest(-30, least(30, {COEF} * odds + {INTERCEPT})))) END AS lp FROM o),
  b AS (SELECT *, CASE WHEN lp IS NOT NULL THEN 400 - {POINTS_FACTOR!r} * {_odds('lp')} END AS bs FROM c)"""


@query(
    "scorecard_apply",
    f"WITH {CARD} SELECT uid, dt, okey, score_old, round(odds, 6) AS odds, round(lp, 8) AS logistic_prob, round(bs, 4) AS bscore FROM b",
)
def _(spark, sf):
    rows = sample(spark, sf).select("uid", "dt", "okey", "score_old")
    card = scorecard.apply_scorecard(rows, "score_old", COEF, INTERCEPT)
    return rounded(rounded(rounded(card, 6, "odds"), 8, "logistic_prob"), 4, "bscore")


@query(
    "scorecard_summary",
    f"""WITH {CARD} SELECT count(*) AS n, round(min(bs), 2) AS bscore_min, round(max(bs), 2) AS bscore_max, round(avg(bs), 2) AS bscore_mean,
      count(*) FILTER (bs < 400) AS below_range, count(*) FILTER (bs > 780) AS above_range, count(*) FILTER (bs IS NULL) AS not_finite,
      {", ".join(f"round(quantile_cont(bs, {p}), 2) AS p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))} FROM b""",
)
def _(spark, sf):
    card = scorecard.apply_scorecard(sample(spark, sf).select("score_old"), "score_old", COEF, INTERCEPT)
    return scorecard.scorecard_summary(card)


def _newton(steps: int = 12) -> str:
    """The same regression by Newton's method: one aggregate over the fitting rows for each step."""
    sql = f"""{S}, f AS MATERIALIZED (SELECT {_odds('score_old')} AS x, y2 AS y FROM s
      WHERE dt BETWEEN DATE '1995-01-01' AND DATE '1998-12-31' AND score_old IS NOT NULL AND y2 IN (0, 1)),
      z AS (SELECT count(*) AS n FROM f), b0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS c)"""
    for i in range(steps):
        sql += f""", g{i} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(c) AS c, sum((p - y) * x) + any_value(a) / 20 AS ga, sum(p - y) AS gc,
          sum(p * (1 - p) * x * x) + 0.05 AS haa, sum(p * (1 - p) * x) AS hac, sum(p * (1 - p)) AS hcc
          FROM (SELECT x, y, a, c, 1 / (1 + exp(-(a * x + c))) AS p FROM f, b{i})),
        b{i + 1} AS MATERIALIZED (SELECT a - (hcc * ga - hac * gc) / (haa * hcc - hac * hac) AS a, c - (haa * gc - hac * ga) / (haa * hcc - hac * hac) AS c FROM g{i})"""
    return sql + f" SELECT n AS fit_rows, round(a, 3) AS coef, round(c, 3) AS intercept FROM z, b{steps}"


@query("scorecard_fit", "WITH " + _newton())
def _(spark, sf):
    """Calibration on the training range."""
    rows = sample(spark, sf).select("uid", "dt", "y2", "score_old")
    fit = project.fit_slice(rows, "dt", SPLITS.range("train")).where(F.col("score_old").isNotNull() & F.col("y2").isin(0, 1))
    coef, intercept = scorecard.fit_calibration(fit, "score_old", "y2")
    return fit.agg(F.count(F.lit(1)).alias("fit_rows")).withColumns(
        {"coef": F.round(F.lit(coef), 3), "intercept": F.round(F.lit(intercept), 3)}
    )


_IDS = ["okey", "pkey", "uid", "line"]

# The deterministic part of the tree jobs: who is trained, judged and delivered. What a forest says is held to bounds.
_SPLIT_SQL = f"""{S}, h AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', okey, pkey, uid, line, '42')), 1, 15) AS BIGINT) AS h
    FROM s WHERE y IS NOT NULL AND dt BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'),
  k AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS i, count(*) OVER (PARTITION BY y) AS n FROM h),
  c AS (SELECT y, max(h) AS cut FROM k WHERE i <= round(n * 0.7) GROUP BY y),
  parts AS (SELECT h.y, CASE WHEN h <= cut THEN 'train' ELSE 'val' END AS split FROM h JOIN c ON h.y = c.y
    UNION ALL SELECT y, 'oot' FROM s WHERE y IS NOT NULL AND {OOT_DAYS})"""


def _parts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = sample(spark, sf).select(*_IDS, "dt", "y", *FEATURES).where(F.col("y").isNotNull())
    dev = project.split_slice(s, "dt", ("19950101", "19991231"))
    parts = stage(select.stratified_split(dev, "y", _IDS))
    oot = project.split_slice(s, "dt", SPLITS.range("oot"))
    return parts.where("part = 'train'").drop("part"), parts.where("part = 'val'").drop("part"), oot


def _within(column: str, low: float, high: float):
    return F.bool_and(F.col(column).isNotNull() & F.col(column).between(low, high))


@query(
    "train_and_evaluate",
    f"""WITH {_SPLIT_SQL}, sides AS (SELECT y, split FROM parts UNION ALL SELECT y, 'all' FROM parts)
    SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS positive, round(avg(y), 6) AS label_rate, TRUE AS metrics_valid FROM sides GROUP BY split""",
)
def _(spark, sf):
    """One experiment cell: weights, split, training, scoring and the evaluation of every split."""
    train, val, oot = _parts(spark, sf)
    cell = run_cell(train, val, oot, FEATURES, "y", run="gbt", dt="dt")
    valid = F.col("auc").between(0, 1) & F.col("ks").between(0, 1) & (F.abs(F.abs(2 * F.col("auc") - 1) - F.col("gini")) < 1e-5)
    return cell.evaluation.select("split", "n", "positive", "label_rate", valid.alias("metrics_valid"))


@query(
    "experiment_cell",
    f"""WITH {_SPLIT_SQL} SELECT 'gbt' AS run, CAST({len(FEATURES)} AS INTEGER) AS n_features, count(*) FILTER (split = 'train') AS train_n,
      count(*) FILTER (split = 'val') AS val_n, count(*) FILTER (split = 'oot') AS oot_n, CAST(1 AS BIGINT) AS rank, TRUE AS diagnosed FROM parts""",
)
def _(spark, sf):
    """The cell's row as the leaderboard and the diagnosis take it."""
    train, val, oot = _parts(spark, sf)
    row = run_cell(train, val, oot, FEATURES, "y", run="gbt", dt="dt").row
    judged = runs.diagnose_runs(runs.leaderboard(row), psi="psi_oot")
    known = F.col("status").isin("overfit", "underfit", "unstable_psi", "well_fit")
    return judged.select("run", "n_features", "train_n", "val_n", "oot_n", "rank", known.alias("diagnosed"))


@query(
    "model_importance",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, TRUE AS share_valid, TRUE AS shares_complete" for f in FEATURES),
)
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    table = models.importance_table(models.train_model(train, val, FEATURES, "y"))
    total = F.sum("gain_pct").over(W.partitionBy(F.lit(1)))  # one row per feature
    return table.select(
        "feature", F.col("gain_pct").between(0, 100).alias("share_valid"), (F.abs(total - 100) < 0.01).alias("shares_complete")
    )


@query(
    "adversarial_validation",
    f"""WITH {S} SELECT count(*) FILTER (dt BETWEEN DATE '1995-01-01' AND DATE '1999-12-31') AS dev_rows, count(*) FILTER ({OOT_DAYS}) AS oot_rows,
      TRUE AS separability_valid, TRUE AS kept_by_tier, TRUE AS kept_are_highest FROM s""",
)
def _(spark, sf):
    """Separability of all development and out-of-time rows, and the rows kept after the recommended drop."""
    s = sample(spark, sf).select(*_IDS, "dt", *FEATURES)
    dev, oot = project.split_slice(s, "dt", ("19950101", "19991231")), project.split_slice(s, "dt", SPLITS.range("oot"))
    model, _, auc = models.train_adversarial(dev, oot, FEATURES, _IDS)
    scored = stage(models.score_rows(dev, model, "proba"))
    share = select.drop_share(auc)
    kept = select.adversarial_drop(scored, "proba", share, _IDS).agg(F.count(F.lit(1)).alias("kept"), F.min("proba").alias("low"))
    dropped = scored.agg(F.count(F.lit(1)).alias("dev_rows"), F.percentile_approx("proba", share, 1_000_000).alias("cut"))
    return dropped.join(F.broadcast(kept), F.lit(True)).join(F.broadcast(oot.agg(F.count(F.lit(1)).alias("oot_rows"))), F.lit(True)).select(
        "dev_rows", "oot_rows", F.lit(0.5 <= auc <= 1 or auc < 0.5 and auc >= 0).alias("separability_valid"),
        (F.col("kept") == F.col("dev_rows") - F.bround(F.col("dev_rows") * F.lit(share))).alias("kept_by_tier"),
        (F.col("low") >= F.col("cut") - 1e-6).alias("kept_are_highest"),
    )


@query(
    "tune_model",
    f"""WITH {_SPLIT_SQL} SELECT CAST(9 AS INTEGER) AS trials, TRUE AS best_is_highest, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_bad
    FROM parts WHERE split = 'oot'""",
)
def _(spark, sf):
    """The neighbourhood of the starting point, each set judged on the same validation rows."""
    train, val, oot = _parts(spark, sf)
    model, best, trials = models.tune_model(train, val, FEATURES, "y", models.neighbourhood())
    highest = dict(best) == max(trials, key=lambda t: t[1])[0]
    result = quality.rank_metrics(models.score_rows(oot, model), "score", "y")
    return result.select(F.lit(len(trials)).alias("trials"), F.lit(highest).alias("best_is_highest"), "n", "n_bad")


@query(
    "deliver_scores",
    f"WITH {S} SELECT uid, dt, TRUE AS score_valid, TRUE AS points_follow FROM s WHERE y IS NULL",
)
def _(spark, sf):
    """Unlabelled rows through sentinels, model and score-card."""
    train, val, _ = _parts(spark, sf)
    model = models.train_model(train, val, FEATURES, "y")
    fresh = sample(spark, sf).where(F.col("y").isNull()).select("uid", "dt", *FEATURES)
    out = deliver_scores(fresh, model, [50.0], (COEF, INTERCEPT))
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("score")))
    points = 400 - POINTS_FACTOR * (COEF * F.log(p / (1 - p)) + INTERCEPT)
    return out.select(
        "uid", "dt", F.col("score").between(0, 1).alias("score_valid"), (F.abs(F.col("bscore") - points) < 1e-3).alias("points_follow")
    )


# What the jobs above produce, in full: trained numbers have no SQL form, tests hold them to their definitions.


@query("delivered_scores")
def _(spark, sf):
    """Every unlabelled row with its score and its points."""
    train, val, _ = _parts(spark, sf)
    model = models.train_model(train, val, FEATURES, "y")
    fresh = sample(spark, sf).where(F.col("y").isNull()).select(*_IDS, "dt", *FEATURES)
    return deliver_scores(fresh, model, [50.0], (COEF, INTERCEPT)).select(*_IDS, "dt", "score", "logistic_prob", "bscore")


@query("split_metrics_and_gains")
def _(spark, sf):
    """AUC, KS and Gini of every split of a trained cell, and the gain of every feature."""
    train, val, oot = _parts(spark, sf)
    cell = run_cell(train, val, oot, FEATURES, "y", run="gbt", dt="dt")
    measures = cell.evaluation.select(F.col("split").alias("item"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in ("n", "auc", "ks", "gini")])))
    gains = models.importance_table(cell.model).select(F.col("feature").alias("item"), F.lit("gain_pct").alias("measure"), F.col("gain_pct").alias("value"))
    return measures.unionByName(gains)


@query("separability_and_importance")
def _(spark, sf):
    """How well development and out-of-time rows can be told apart, the drop share that follows, and by which features."""
    s = sample(spark, sf).select(*_IDS, "dt", *FEATURES)
    dev, oot = project.split_slice(s, "dt", ("19950101", "19991231")), project.split_slice(s, "dt", SPLITS.range("oot"))
    _, importance, auc = models.train_adversarial(dev, oot, FEATURES, _IDS)
    return importance.withColumns({"separability": F.lit(auc), "drop_share": F.lit(select.drop_share(auc))})


@query("tuning_trials")
def _(spark, sf):
    """25 trials by successive halving: parameters, rounds and validation AUC of each."""
    train, val, _ = _parts(spark, sf)
    _, best, report = models.halving_search(train, val, FEATURES, "y", models.sampled_trials())
    rows = [(r["trial"], r["maxDepth"], r["stepSize"], r["subsamplingRate"], r["minInstancesPerNode"], r["rounds"], r["auc"], all(best[k] == r[k] for k in best)) for r in report]
    return spark.createDataFrame(
        rows, "trial int, depth int, step double, row_share double, leaf_rows int, rounds int, auc double, chosen boolean"
    )


# Run tables.
RUNS = f"""{S}, t AS (SELECT uid, score_old, score_new, y2, {SPLIT_TAG} AS split FROM s),
  m AS ({rank_sql('t', ['uid', 'split'], 'score_old', 'y2', 'split IS NOT NULL')}),
  hb AS (SELECT uid, split, floor(score_old * 10) AS bin, count(*) / sum(count(*)) OVER (PARTITION BY uid, split) AS share
         FROM t WHERE split IN ('train', 'oot') AND score_old IS NOT NULL GROUP BY uid, split, bin),
  ps AS (SELECT uid, round(sum((a - b) * ln((a + 1e-10) / (b + 1e-10))), 8) AS psi FROM (SELECT uid, bin,
          coalesce(max(share) FILTER (split = 'oot'), 0) AS a, coalesce(max(share) FILTER (split = 'train'), 0) AS b FROM hb GROUP BY uid, bin) GROUP BY uid),
  runs AS (SELECT uid AS run, concat('algo_', uid % 3) AS algo, round(max(auc) FILTER (split = 'train'), 8) AS train_auc,
      round(max(auc) FILTER (split = 'oot'), 8) AS oot_auc, psi, 920 + uid % 60 AS best_iter
    FROM m JOIN ps USING (uid) GROUP BY uid, psi)"""


def _runs(spark, sf) -> DataFrame:
    t = project.split_tag(sample(spark, sf), "dt", SPLITS)
    m = quality.rank_metrics(t, "score_old", "y2", ["uid", "split"])

    def of(split: str):
        return sql_round(F.max(F.when(F.col("split") == split, F.col("auc"))), 8)

    table = m.groupBy("uid").agg(of("train").alias("train_auc"), of("oot").alias("oot_auc"))
    hist = t.where(F.col("score_old").isNotNull()).groupBy("uid", "split", F.floor(F.col("score_old") * 10).alias("bin")).count()
    share = hist.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy("uid", "split")))
    psi = stability.psi_proportions(share.where("split = 'oot'"), share.where("split = 'train'"), ["uid"])
    return table.join(rounded(psi, 8, "psi"), "uid").select(
        F.col("uid").alias("run"), F.concat(F.lit("algo_"), (F.col("uid") % 3).cast("string")).alias("algo"),
        "train_auc", "oot_auc", "psi", (F.lit(920) + F.col("uid") % 60).alias("best_iter"),
    )


@query(
    "leaderboard",
    f"WITH {RUNS} SELECT *, row_number() OVER (ORDER BY oot_auc DESC NULLS LAST, run) AS rank FROM runs",
)
def _(spark, sf):
    return runs.leaderboard(_runs(spark, sf))


_LONG_ID = "repeat('x', 60) || CAST(l_orderkey AS VARCHAR)"


@query(
    "leaderboard_text",
    f"""WITH r AS (SELECT {_LONG_ID} AS run, CASE WHEN max(l_tax) > 0 THEN round(max(l_tax), 2) END AS oot_auc FROM lineitem GROUP BY l_orderkey)
    SELECT run, oot_auc, row_number() OVER (ORDER BY oot_auc DESC NULLS LAST, run) AS rank FROM r""",
)
def _(spark, sf):
    """Run ids that differ after 60 equal characters, with few distinct metrics and some missing."""
    top = F.max("l_tax")
    r = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.when(top > 0, F.round(top, 2)).otherwise(F.lit(float("nan"))).alias("oot_auc"))
    named = r.select(F.concat(F.lit("x" * 60), F.col("l_orderkey").cast("string")).alias("run"), "oot_auc")
    board = runs.leaderboard(named)
    return board.withColumn("oot_auc", F.when(~F.isnan("oot_auc"), F.col("oot_auc")))


@query("top_runs", f"WITH {RUNS} SELECT * FROM runs WHERE oot_auc IS NOT NULL ORDER BY oot_auc DESC, run LIMIT 10")
def _(spark, sf):
    return runs.top_runs(_runs(spark, sf), 10)


@query(
    "best_per_algo",
    f"""WITH {RUNS} SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY algo ORDER BY oot_auc DESC, run) AS k
    FROM runs WHERE oot_auc IS NOT NULL) WHERE k = 1""",
)
def _(spark, sf):
    return runs.best_per_algo(_runs(spark, sf))


@query(
    "diagnose_runs",
    f"""WITH {RUNS}, d AS (SELECT *, CASE WHEN train_auc - oot_auc > 0.05 THEN 'overfit'
        WHEN train_auc - oot_auc < 0.005 OR train_auc < 0.70 THEN 'underfit' END AS a,
      CASE WHEN best_iter / 1000.0 >= 0.95 THEN 'underconverged' END AS b, CASE WHEN psi > 0.10 THEN 'unstable_psi' END AS c FROM runs)
    SELECT run, algo, train_auc, oot_auc, psi, best_iter, CAST(1000 AS INTEGER) AS n_estimators, coalesce(a, b, c, 'well_fit') AS status,
      concat_ws(',', a, b, c) AS reasons, round(train_auc - oot_auc, 8) AS train_oot_gap FROM d""",
)
def _(spark, sf):
    table = _runs(spark, sf).withColumn("n_estimators", F.lit(1000))
    d = runs.diagnose_runs(table, best_iter="best_iter", n_estimators="n_estimators", psi="psi")
    return rounded(d, 8, "train_oot_gap")


# "Reported" metrics are taken on scores rounded to two digits, so some runs agree and some do not.
@query(
    "metric_reconcile",
    f"""WITH {S}, t AS (SELECT uid, score_old, round(score_old, 2) AS coarse, y2, {SPLIT_TAG} AS split FROM s),
      a AS ({rank_sql('t', ['uid', 'split'], 'coarse', 'y2', 'split IS NOT NULL')}), b AS ({rank_sql('t', ['uid', 'split'], 'score_old', 'y2', 'split IS NOT NULL')})
    SELECT a.uid AS run, a.split, round(a.auc, 8) AS reported, round(b.auc, 8) AS computed, round(abs(round(a.auc, 8) - round(b.auc, 8)), 8) AS delta,
      CASE WHEN b.auc IS NULL THEN 'not_computed' WHEN abs(round(a.auc, 8) - round(b.auc, 8)) <= 5e-4 THEN 'ok' ELSE 'differs' END AS status
    FROM a LEFT JOIN b ON a.uid = b.uid AND a.split = b.split""",
)
def _(spark, sf):
    t = project.split_tag(sample(spark, sf), "dt", SPLITS).withColumn("coarse", sql_round(F.col("score_old"), 2))
    keys = ["run", "split"]

    def metric(score: str) -> DataFrame:
        m = quality.rank_metrics(t, score, "y2", ["uid", "split"])
        return m.select(F.col("uid").alias("run"), "split", sql_round(F.col("auc"), 8).alias("value"))

    return rounded(runs.metric_reconcile(metric("coarse"), metric("score_old"), keys), 8, "delta")


@query(
    "mean_reconcile",
    f"""WITH {CARD}, t AS (SELECT *, {SPLIT_TAG} AS split FROM b WHERE bs IS NOT NULL),
      ma AS (SELECT uid, avg(bs) AS m FROM t WHERE split = 'train' GROUP BY uid), mc AS (SELECT uid, avg(bs) AS m FROM t WHERE split = 'oot' GROUP BY uid)
    SELECT a.uid AS run, round(a.m, 4) AS reported, round(c.m, 4) AS computed, round(abs(a.m - c.m), 4) AS delta,
      CASE WHEN c.m IS NULL THEN 'not_computed' WHEN abs(a.m - c.m) <= greatest(30, 0.03 * abs(c.m)) THEN 'ok' ELSE 'differs' END AS status
    FROM ma a LEFT JOIN mc c ON a.uid = c.uid""",
)
def _(spark, sf):
    t = project.split_tag(sample(spark, sf), "dt", SPLITS).where(F.col("score_old").isNotNull())
    card = scorecard.apply_scorecard(t, "score_old", COEF, INTERCEPT)

    def mean(split: str) -> DataFrame:
        rows = card.where(F.col("split") == split)
        return rows.groupBy(F.col("uid").alias("run")).agg(F.avg("bscore").alias("value"))

    return rounded(runs.metric_reconcile(mean("train"), mean("oot"), ["run"], tolerance=None), 4, "reported", "computed", "delta")


@query(
    "noise_pairs",
    f"""WITH {S}, t AS (SELECT *, {SPLIT_TAG} AS split FROM s), a AS ({rank_sql('t', ['uid'], 'score_new', 'y2', "split = 'oot'")}),
      b AS ({rank_sql('t', ['uid'], 'score_old', 'y2', "split = 'oot'")}),
      d AS (SELECT a.uid, round(b.auc, 8) - round(a.auc, 8) AS delta, least(a.n, b.n) AS n FROM a JOIN b ON a.uid = b.uid)
    SELECT uid, round(delta, 8) AS delta, n, CASE WHEN abs(delta) < 0.005 AND n < 5000 THEN 'noise' WHEN delta > 0 THEN 'better' WHEN delta < 0 THEN 'worse' ELSE 'equal' END AS verdict FROM d""",
)
def _(spark, sf):
    oot = project.split_slice(sample(spark, sf), "dt", SPLITS.range("oot"))
    sides = [rounded(quality.rank_metrics(oot, s, "y2", ["uid"]), 8, "auc") for s in ("score_new", "score_old")]
    return rounded(runs.noise_pairs(sides[0], sides[1], ["uid"]), 8, "delta")


@query(
    "label_families",
    """SELECT DISTINCT concat(CASE l_linenumber WHEN 1 THEN 'fpd7_sx' WHEN 2 THEN 'fpd15_a' WHEN 3 THEN 'fpd30_b' ELSE 'dpd30_' END, CAST(l_quantity AS INTEGER)) AS label,
      CASE l_linenumber WHEN 1 THEN 'fpd7' WHEN 2 THEN 'fpd15' WHEN 3 THEN 'fpd30' ELSE concat('dpd30_', CAST(l_quantity AS INTEGER)) END AS family FROM lineitem""",
)
def _(spark, sf):
    line = F.col("line")
    prefix = F.when(line == 1, "fpd7_sx").when(line == 2, "fpd15_a").when(line == 3, "fpd30_b").otherwise("dpd30_")
    names = sample(spark, sf).select(F.concat(prefix, F.col("qty").cast("int").cast("string")).alias("label"))
    return names.distinct().select("label", label_family(F.col("label")).alias("family"))
