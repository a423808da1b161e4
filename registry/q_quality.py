"""Score quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.base import (
    FEATURES, MODELS, OOT, OOT_MONTHS, S, SPLIT_TAG, SPLITS, long_sql, pairs_sql, rank_sql, rounded, sample,
)
from registry.q_profiling import _psi_cte, iv_cte
from riskspark.operators import iv, project, quality


@query("auc", f"WITH {S} SELECT n, round(auc, 8) AS auc FROM ({rank_sql('s', [], 'score_new', 'y')})")
def _(spark, sf):
    return rounded(quality.auc(sample(spark, sf), "score_new", "y"), 8, "auc")


@query("ks", f"WITH {S} SELECT n, round(ks, 8) AS ks FROM ({rank_sql('s', [], 'score_old', 'y')})")
def _(spark, sf):
    return rounded(quality.ks(sample(spark, sf), "score_old", "y"), 8, "ks")


@query("gini", f"WITH {S} SELECT n, round(gini, 8) AS gini FROM ({rank_sql('s', [], 'score_old', 'y2')})")
def _(spark, sf):
    return rounded(quality.gini(sample(spark, sf), "score_old", "y2"), 8, "gini")


@query(
    "rank_metrics_by_month",
    f"""WITH {S} SELECT month, n, n_bad, round(auc, 8) AS auc, round(ks, 8) AS ks, round(gini, 8) AS gini
    FROM ({rank_sql('s', ['month'], 'score_old', 'y')})""",
)
def _(spark, sf):
    return rounded(quality.rank_metrics(sample(spark, sf), "score_old", "y", ["month"]), 8, "auc", "ks", "gini")


@query(
    "confusion_metrics",
    f"""WITH {S}, c AS (SELECT month, count(*) AS n, count(*) FILTER (score_new >= 0.5 AND y = 1) AS tp, count(*) FILTER (score_new < 0.5 AND y = 0) AS tn,
      count(*) FILTER (score_new >= 0.5 AND y = 0) AS fp, count(*) FILTER (score_new < 0.5 AND y = 1) AS fn
      FROM s WHERE score_new IS NOT NULL AND y IS NOT NULL GROUP BY month),
      r AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r FROM c)
    SELECT month, n, tp, tn, fp, fn, round((tp + tn) / n, 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall,
      round(CASE WHEN p > 0 AND r > 0 THEN 2.0 * p * r / (p + r) END, 6) AS f1 FROM r""",
)
def _(spark, sf):
    return quality.confusion_metrics(sample(spark, sf), "score_new", "y", 0.5, ["month"])


def _decile_sql(keys: str, where: str) -> str:
    """Row positions by falling score; ties by label, then quantity."""
    pre = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""p AS (SELECT {pre}score_new AS sc, y, qty, row_number() OVER ({part} ORDER BY score_new DESC, y, qty) - 1 AS i,
        count(*) OVER ({part}) AS n FROM t WHERE {where} AND score_new IS NOT NULL AND y IS NOT NULL),
      d AS (SELECT {pre}sc, y, qty, 11 - CASE WHEN n > 1 THEN greatest(1, (i * 10 + n - 2) // (n - 1)) ELSE 5 END AS decile FROM p),
      b AS (SELECT {pre}decile, count(*) AS c, min(sc) AS lo, max(sc) AS hi, sum(y) AS pos, avg(qty) AS qty FROM d GROUP BY {pre}decile),
      w AS (SELECT *, sum(pos) OVER ({part}) AS p, sum(c) OVER ({part}) AS m, sum(pos) OVER ({part} ORDER BY decile DESC) AS cp FROM b)
    SELECT {pre}CAST(decile AS INTEGER) AS decile, CAST(c AS BIGINT) AS count, round(lo, 4) AS score_min, round(hi, 4) AS score_max, round(pos / c, 6) AS label_rate,
      round((pos / c) / (p / m), 4) AS lift, round(pos / p, 4) AS recall, round(cp / p, 4) AS cum_recall, round(qty, 4) AS qty FROM w"""


@query("decile_table", f"WITH {S}, t AS (SELECT * FROM s), {_decile_sql('', 'TRUE')}")
def _(spark, sf):
    return quality.decile_table(sample(spark, sf), "score_new", "y", biz_cols=["qty"])


@query(
    "decile_table_by_split",
    f"WITH {S}, t AS (SELECT *, {SPLIT_TAG} AS split FROM s), {_decile_sql('split', 'split IS NOT NULL')}",
)
def _(spark, sf):
    tagged = project.split_tag(sample(spark, sf), "dt", SPLITS)
    return quality.decile_table(tagged, "score_new", "y", ["split"], ["qty"])


@query(
    "split_deciles",
    f"""WITH {S}, t0 AS (SELECT *, {SPLIT_TAG} AS split FROM s),
      t AS (SELECT * FROM t0 WHERE split IS NOT NULL UNION ALL SELECT * REPLACE ('all' AS split) FROM t0 WHERE split IS NOT NULL),
      {_decile_sql('split', 'TRUE')}""",
)
def _(spark, sf):
    return quality.split_deciles(project.split_tag(sample(spark, sf), "dt", SPLITS), "score_new", "y", "split", ["qty"])


@query(
    "split_score_psi",
    f"""WITH {S}, u AS (SELECT score_old, {SPLIT_TAG} AS side FROM s), l AS (SELECT side, 'score_old' AS feature, score_old AS value FROM u WHERE side IN ('test', 'oot')),
      {_psi_cte('side', "side = 'test'", 'l')} SELECT feature, round(psi, 8) AS psi FROM psi WHERE side = 'oot'""",
)
def _(spark, sf):
    tagged = project.split_tag(sample(spark, sf), "dt", SPLITS)
    return rounded(quality.split_score_psi(tagged, "score_old", "split", "test", "oot", digits=6), 8, "psi")


@query(
    "split_evaluation",
    f"""WITH {S}, t AS (SELECT score_old, y, {SPLIT_TAG} AS split FROM s),
      u AS (SELECT * FROM t WHERE split IS NOT NULL UNION ALL SELECT score_old, y, 'all' FROM t WHERE split IS NOT NULL)
    SELECT split, n, n_bad AS positive, round(n_bad / n, 6) AS label_rate, round(auc, 6) AS auc, round(ks, 6) AS ks, round(gini, 6) AS gini
    FROM ({rank_sql('u', ['split'], 'score_old', 'y')})""",
)
def _(spark, sf):
    return quality.split_evaluation(project.split_tag(sample(spark, sf), "dt", SPLITS), "score_old", "y", "split")


@query(
    "model_feature_iv",
    f"""WITH {S}, t AS (SELECT * FROM s WHERE dt BETWEEN DATE '1995-01-01' AND DATE '1998-12-31'),
      l AS ({long_sql('t', ['y2'])}), {iv_cte('feature', 'y2')}
    SELECT feature, round(sum(iv_part), 6) AS iv FROM v GROUP BY feature""",
)
def _(spark, sf):
    train = project.split_slice(sample(spark, sf), "dt", SPLITS.range("train"))
    return rounded(iv.feature_iv(train, "y2", FEATURES, digits=6), 6, "iv")


KS_GRID = f"""p AS ({pairs_sql('s', ['month'])}),
    grid AS (SELECT model, label, month, n, CASE WHEN n >= 200 THEN round(ks, 4) END AS ks FROM ({rank_sql('p', ['model', 'label', 'month'], 'score', 'y')}))"""


@query("ks_grid", f"WITH {S}, {KS_GRID} SELECT * FROM grid")
def _(spark, sf):
    return quality.ks_grid(sample(spark, sf), "month", MODELS, ["y", "y2"], 200)


@query(
    "ks_delta",
    f"""WITH {S}, {KS_GRID} SELECT month, label, round(max(ks) FILTER (model = 'new') - max(ks) FILTER (model = 'old'), 4) AS delta
    FROM grid GROUP BY month, label""",
)
def _(spark, sf):
    return quality.ks_delta(quality.ks_grid(sample(spark, sf), "month", MODELS, ["y", "y2"], 200), "month", "new", "old")


@query(
    "ks_oot",
    f"""WITH {S}, p AS ({pairs_sql('s', [], where=OOT)}) SELECT model, label, n, round(ks, 4) AS ks
    FROM ({rank_sql('p', ['model', 'label'], 'score', 'y')})""",
)
def _(spark, sf):
    return quality.ks_oot(sample(spark, sf), "month", MODELS, ["y", "y2"], OOT_MONTHS)
