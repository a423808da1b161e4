"""Business evaluation report, on the sample reduced to one row per month and user."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry import query
from registry.base import MODELS, OOT, OOT_MONTHS, S, bin_sql, edges_sql, pairs_sql, rank_sql, rounded, sample
from riskspark.operators import report
from riskspark.sources.staging import stage

_COLS = ["y", "y2", "score_new", "score_old", "okey", "line"]
_R = f"""{S}, r AS (SELECT month, uid, """ + ", ".join(
    f"first({c} ORDER BY okey, line, {c}) FILTER ({c} IS NOT NULL) AS {c}" for c in _COLS
) + " FROM s GROUP BY month, uid)"


def _frame(spark, sf) -> DataFrame:
    rows = sample(spark, sf).select("uid", "dt", *_COLS)
    return stage(report.report_frame(rows, "uid", "dt", ["okey", "line"]))


def _total_zero(df: DataFrame, *axes: str) -> DataFrame:
    return df.withColumns({a: F.coalesce(F.col(a).cast("int"), F.lit(0)) for a in axes})


@query(
    "report_month_stats",
    f"""WITH {_R} SELECT month, count(DISTINCT uid) AS users, count(y) AS performed, count(*) FILTER (y > 0) AS bad,
      CASE WHEN count(y) >= 60 THEN round(count(*) FILTER (y > 0) / count(y), 8) END AS bad_rate FROM r GROUP BY month""",
)
def _(spark, sf):
    return rounded(report.month_stats(_frame(spark, sf), "month", "uid", "y", 60), 8, "bad_rate")


@query(
    "report_label_grid",
    f"""WITH {_R}, u AS (SELECT month, 'y' AS label, y AS v FROM r UNION ALL SELECT month, 'y2', y2 FROM r)
    SELECT month, label, count(v) AS performed, count(*) FILTER (v > 0) AS bad,
      CASE WHEN count(v) >= 60 THEN round(count(*) FILTER (v > 0) / count(v), 8) END AS bad_rate FROM u GROUP BY month, label""",
)
def _(spark, sf):
    return rounded(report.label_grid(_frame(spark, sf), "month", ["y", "y2"], 60), 8, "bad_rate")


@query(
    "lift_table",
    f"""WITH {_R}, p AS ({pairs_sql('r', [], where=OOT)}), e AS ({edges_sql('p', 'model, label', 'score', min_rows=1)}),
      c AS (SELECT model, label, {bin_sql('score')} AS bin, count(*) AS n, count(*) FILTER (y > 0) AS bad FROM p JOIN e USING (model, label) GROUP BY ALL),
      t AS (SELECT model, label, sum(n) AS tn, sum(bad) AS tb FROM c GROUP BY model, label)
    SELECT model, label, CAST(bin AS INTEGER) AS bin, n, bad, CASE WHEN n >= 30 THEN round(bad / n, 8) END AS bad_rate,
      CASE WHEN n >= 30 THEN round((bad / n) / (tb / tn), 4) END AS lift FROM c JOIN t USING (model, label)
    UNION ALL SELECT model, label, 0, CAST(tn AS BIGINT), CAST(tb AS BIGINT), round(tb / tn, 8), NULL FROM t""",
)
def _(spark, sf):
    oot = _frame(spark, sf).where(F.col("month").between(*OOT_MONTHS))
    return _total_zero(rounded(report.lift_table(oot, MODELS, ["y", "y2"], digits=6), 8, "bad_rate"), "bin")


_SWAP = f"""{_R}, b AS (SELECT score_old AS o, score_new AS w, y FROM r WHERE {OOT} AND score_old IS NOT NULL AND score_new IS NOT NULL AND y IS NOT NULL),
  eo AS ({edges_sql('(SELECT 1 AS k, o FROM b)', 'k', 'o', 5, min_rows=1).replace(' AS e\n', ' AS eo\n')}),
  en AS ({edges_sql('(SELECT 1 AS k, w FROM b)', 'k', 'w', 5, min_rows=1).replace(' AS e\n', ' AS en\n')}),
  x AS (SELECT b.o, b.w, b.y, {bin_sql('b.o', 'eo.eo')} AS ob, {bin_sql('b.w', 'en.en')} AS nb FROM b, eo, en)"""


@query(
    "swap_matrix",
    f"""WITH {_SWAP}, g AS (SELECT ob, nb FROM (SELECT unnest(range(1, len(eo))) AS ob FROM eo), (SELECT unnest(range(1, len(en))) AS nb FROM en)),
      f AS (SELECT g.ob, g.nb, count(x.y) AS n, count(*) FILTER (x.y > 0) AS bad FROM g LEFT JOIN x ON x.ob = g.ob AND x.nb = g.nb GROUP BY g.ob, g.nb),
      c AS (SELECT CAST(coalesce(ob, 0) AS INTEGER) AS old_bin, CAST(coalesce(nb, 0) AS INTEGER) AS new_bin, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad
            FROM f GROUP BY CUBE (ob, nb))
    SELECT *, CASE WHEN n >= 30 THEN round(bad / n, 8) END AS bad_rate FROM c""",
)
def _(spark, sf):
    oot = _frame(spark, sf).where(F.col("month").between(*OOT_MONTHS))
    m = report.swap_matrix(oot, "score_old", "score_new", "y", digits=6)
    return _total_zero(rounded(m, 8, "bad_rate"), "old_bin", "new_bin")


@query(
    "swap_bin_ranges",
    f"""WITH {_SWAP} SELECT 'old' AS side, CAST(ob AS INTEGER) AS bin, min(o) AS low, max(o) AS high FROM x GROUP BY ob
    UNION ALL SELECT 'new', CAST(nb AS INTEGER), min(w), max(w) FROM x GROUP BY nb""",
)
def _(spark, sf):
    oot = _frame(spark, sf).where(F.col("month").between(*OOT_MONTHS))
    return report.swap_bin_ranges(oot, "score_old", "score_new", "y", digits=6)


# Points-like copy of a score for the 10-point grid.
def _points(spark, sf) -> DataFrame:
    return _frame(spark, sf).withColumn("points", F.round(F.lit(400.0) + F.col("score_old") * 300.0, 1))


_P = f"{_R}, rp AS (SELECT *, round(CAST(400 AS DOUBLE) + score_old * 300.0, 1) AS points FROM r)"


def _cells(source: str, score: str, points: bool, side: str) -> str:
    """(month, i, n…) on the raw grid, edges counted from an explicit list."""
    grid = (
        f"(SELECT [CAST(x AS DOUBLE) for x in range(CAST(floor(min({score}) / 10) * 10 AS BIGINT), CAST(ceil(max({score}) / 10) * 10 AS BIGINT) + 1, 10)] AS ed FROM {source})"
        if points
        else "(SELECT [x / 10.0 for x in range(0, 11)] AS ed)"
    )
    index = (
        f"least(len(ed) - 2, len([x for x in ed if x <= {score}]) - 1)"
        if side == "left"
        else f"greatest(0, len([x for x in ed if x < {score}]) - 1)"
    )
    return f"SELECT *, CASE WHEN {score} IS NOT NULL THEN {index} END AS i, ed FROM {source}, {grid}"


def _bins(source: str, score: str, points: bool) -> str:
    return f"""ix AS ({_cells(source, score, points, 'left')}),
      sh AS (SELECT month, i, count(*) / sum(count(*)) OVER (PARTITION BY month) AS share FROM ix WHERE i IS NOT NULL GROUP BY month, i),
      ht AS (SELECT min(i) FILTER (share >= 0.01) AS h, max(i) FILTER (share >= 0.01) AS t FROM sh),
      kt AS (SELECT coalesce(h, 0) AS h, coalesce(t, (SELECT max(len(ed)) - 2 FROM ix)) AS t FROM ht),
      nb AS (SELECT t - h + 1 AS nbins, h, t FROM kt)"""


for _name, _score, _pts in (("", "score_new", False), ("_points", "points", True)):
    _src = "rp" if _pts else "r"
    _w = f"WITH {_P}, {_bins(_src, _score, _pts)}"
    _dist = f"""{_w}, mb AS (SELECT month, b AS bin FROM (SELECT DISTINCT month FROM ix), (SELECT unnest(range(1, nbins + 1)) AS b FROM nb)),
      cn AS (SELECT month, greatest(h, least(t, i)) - h + 1 AS bin, count(*) AS n FROM ix, nb WHERE i IS NOT NULL GROUP BY ALL),
      ds AS (SELECT mb.month, CAST(mb.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM mb LEFT JOIN cn USING (month, bin))"""

    @query(
        f"score_bins{_name}",
        f"""{_w}, ee AS (SELECT any_value(ed) AS ed FROM ix),
          bb AS (SELECT unnest(range(1, nbins + 1)) AS b, nbins, h FROM nb),
          lh AS (SELECT b, CASE WHEN b = 1 THEN ed[1] ELSE ed[h + b] END AS low, CASE WHEN b = nbins THEN ed[-1] ELSE ed[h + b + 1] END AS high FROM bb, ee)
        SELECT CAST(b AS INTEGER) AS bin, low, high,
          concat(CASE WHEN low = floor(low) THEN CAST(CAST(low AS BIGINT) AS VARCHAR) ELSE CAST(low AS VARCHAR) END, '-',
            CASE WHEN high = floor(high) THEN CAST(CAST(high AS BIGINT) AS VARCHAR) ELSE CAST(high AS VARCHAR) END) AS bin_label FROM lh""",
    )
    def _(spark, sf, score=_score):
        return report.score_bins(_points(spark, sf), "month", score)

    @query(
        f"score_distribution{_name}",
        f"""{_dist}, tt AS (SELECT month, sum(n) AS tn FROM ds GROUP BY month)
        SELECT month, bin, n, round(coalesce(n / nullif(tn, 0), 0), 8) AS share FROM ds JOIN tt USING (month)
        UNION ALL SELECT month, 0, CAST(tn AS BIGINT), CASE WHEN tn > 0 THEN 1.0 ELSE 0.0 END FROM tt""",
    )
    def _(spark, sf, score=_score):
        return _total_zero(rounded(report.score_distribution(_points(spark, sf), "month", score), 8, "share"), "bin")

    @query(
        f"score_psi{_name}",
        f"""{_dist}, sa AS (SELECT month, bin, n / nullif(sum(n) OVER (PARTITION BY month), 0) AS a FROM ds),
          sb AS (SELECT bin, coalesce(a, 0) AS b FROM sa WHERE month = '2000-01')
        SELECT month, round(sum((a - coalesce(b, 0)) * ln((a + 1e-10) / (coalesce(b, 0) + 1e-10))), 4) + 0.0 AS psi
        FROM sa LEFT JOIN sb USING (bin) GROUP BY month""",
    )
    def _(spark, sf, score=_score):
        return report.score_psi(_points(spark, sf), "month", score, "2000-01")

    @query(
        f"segment_bad_rate{_name}",
        f"""{_w}, rx AS ({_cells(_src, _score, _pts, 'right')}),
          ll AS (SELECT 'y' AS label, month, i, y AS v FROM rx WHERE i IS NOT NULL UNION ALL SELECT 'y2', month, i, y2 FROM rx WHERE i IS NOT NULL),
          cc AS (SELECT label, month, greatest(h, least(t, i)) - h + 1 AS bin, count(v) AS n, count(*) FILTER (v > 0) AS bad FROM ll, nb GROUP BY ALL),
          gg AS (SELECT label, month, b AS bin FROM (SELECT DISTINCT label, month FROM ll), (SELECT unnest(range(1, nbins + 1)) AS b FROM nb)),
          ff AS (SELECT gg.*, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad FROM gg LEFT JOIN cc USING (label, month, bin)),
          tt AS (SELECT label, month, CAST(coalesce(bin, 0) AS INTEGER) AS bin, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad
                 FROM ff GROUP BY GROUPING SETS ((label, month, bin), (label, month)))
        SELECT *, CASE WHEN n >= 10 THEN round(bad / n, 8) END AS bad_rate FROM tt""",
    )
    def _(spark, sf, score=_score):
        t = report.segment_bad_rate(_points(spark, sf), "month", score, ["y", "y2"], 10)
        return _total_zero(rounded(t, 8, "bad_rate"), "bin")


def _check_psi(score: str) -> str:
    return f"""(WITH {_bins('r', score, False)}, mb AS (SELECT month, b AS bin FROM (SELECT DISTINCT month FROM ix), (SELECT unnest(range(1, nbins + 1)) AS b FROM nb)),
      cn AS (SELECT month, greatest(h, least(t, i)) - h + 1 AS bin, count(*) AS n FROM ix, nb WHERE i IS NOT NULL GROUP BY ALL),
      ds AS (SELECT mb.month, mb.bin, coalesce(n, 0) AS n FROM mb LEFT JOIN cn USING (month, bin)),
      sa AS (SELECT month, bin, n / nullif(sum(n) OVER (PARTITION BY month), 0) AS a FROM ds),
      sb AS (SELECT bin, coalesce(a, 0) AS b FROM sa WHERE month = '2000-01'),
      pp AS (SELECT month, round(sum((a - b) * ln((a + 1e-10) / (b + 1e-10))), 4) AS psi FROM sa JOIN sb USING (bin) GROUP BY month)
      SELECT max(psi) AS psi, count(psi) AS k, (SELECT nbins FROM nb) AS nbins FROM pp)"""


@query(
    "report_checks",
    f"""WITH {_R}, p AS ({pairs_sql('r', [], where=OOT)}), ck AS ({rank_sql('p', ['model', 'label'], 'score', 'y')}),
      pn AS {_check_psi('score_new')}, po AS {_check_psi('score_old')}
    SELECT 'score_rows' AS "check", 'new' AS model, NULL AS label, CAST(count(score_new) AS DOUBLE) AS value, count(score_new) = 0 AS failed FROM r
    UNION ALL SELECT 'score_rows', 'old', NULL, count(score_old), count(score_old) = 0 FROM r
    UNION ALL SELECT 'label_positives', NULL, 'y', count(*) FILTER (y > 0), count(*) FILTER (y > 0) = 0 FROM r
    UNION ALL SELECT 'label_positives', NULL, 'y2', count(*) FILTER (y2 > 0), count(*) FILTER (y2 > 0) = 0 FROM r
    UNION ALL SELECT 'rows_with_all_scores', NULL, 'y', count(*) FILTER ({OOT} AND score_old IS NOT NULL AND y IS NOT NULL), FALSE FROM r
    UNION ALL SELECT 'rows_with_all_scores', NULL, 'y2', count(*) FILTER ({OOT} AND score_old IS NOT NULL AND y2 IS NOT NULL), FALSE FROM r
    UNION ALL SELECT 'oot_ks', model, label, round(ks, 8), NOT (ks > 0 AND ks < 1) FROM ck WHERE n_bad > 0
    UNION ALL SELECT 'score_bins', 'new', NULL, nbins, nbins <= 1 FROM pn UNION ALL SELECT 'score_bins', 'old', NULL, nbins, nbins <= 1 FROM po
    UNION ALL SELECT 'max_month_psi', 'new', NULL, psi, k >= 2 AND abs(psi) < 1e-9 FROM pn
    UNION ALL SELECT 'max_month_psi', 'old', NULL, psi, k >= 2 AND abs(psi) < 1e-9 FROM po""",
)
def _(spark, sf):
    c = report.report_checks(_frame(spark, sf), "month", MODELS, ["y", "y2"], OOT_MONTHS, "2000-01")
    return rounded(c, 8, "value")
