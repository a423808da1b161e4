"""Label and feature profiles, binning, PSI and IV."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.base import (
    FEATURES, S, SPLIT_TAG, SPLITS, bin_sql, edges_sql, long_sql, rounded, sample, table,
)
from riskspark.operators import bins, feature_cube, iv, profile, project, stability
from riskspark.operators.bins import unpivot_features

BASE_MONTH = "2000-01"
LONG = f"l AS ({long_sql('s', ['month', 'y'])})"


@query(
    "monthly_label_rate",
    f"""WITH {S} SELECT month, label, count(v) AS total, count(*) FILTER (v = 1) AS overdue,
      coalesce(round(count(*) FILTER (v = 1) / nullif(count(v), 0), 6), 0) AS rate
    FROM (SELECT month, 'y' AS label, y AS v FROM s UNION ALL SELECT month, 'y2', y2 FROM s) GROUP BY month, label""",
)
def _(spark, sf):
    return profile.monthly_label_rate(sample(spark, sf), "month", ["y", "y2"])


_QS = profile.DISTRIBUTION_QUANTILES
_QN = [f"q{round(p * 100):02d}" for p in _QS]


@query(
    "feature_distribution",
    f"""WITH {S}, {LONG} SELECT feature, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS coverage,
      round(avg(value), 4) AS mean, min(value) AS min, max(value) AS max,
      {", ".join(f"round(quantile_cont(value, {p}), 4) AS {n}" for p, n in zip(_QS, _QN))} FROM l GROUP BY feature""",
)
def _(spark, sf):
    d = profile.feature_distribution(sample(spark, sf), FEATURES)
    return rounded(rounded(d, 4, "mean", *_QN), 6, "coverage")


@query(
    "monthly_feature_stats",
    f"""WITH {S}, {LONG} SELECT feature, month, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS coverage,
      round(avg(value), 4) AS mean, min(value) AS min, max(value) AS max, round(stddev_samp(value), 4) AS std,
      count(DISTINCT value) AS n_unique FROM l GROUP BY feature, month""",
)
def _(spark, sf):
    d = profile.monthly_feature_stats(sample(spark, sf), "month", FEATURES)
    return rounded(rounded(d, 4, "mean", "std"), 6, "coverage")


@query(
    "quantile_edges",
    f"""WITH {S}, {LONG}, e AS ({edges_sql('l', 'feature')})
    SELECT feature, n, CAST(i - 1 AS INTEGER) AS pos, round(e[i], 6) AS edge
    FROM (SELECT feature, n, e, unnest(range(1, len(e) + 1)) AS i FROM e)""",
)
def _(spark, sf):
    e = bins.quantile_edges(unpivot_features(sample(spark, sf), [], FEATURES), ["feature"], digits=6)
    return e.select("feature", "n", F.posexplode("edges").alias("pos", "edge")).withColumn("edge", F.round("edge", 6))


@query(
    "bin_assign",
    f"""WITH {S}, {LONG}, e AS ({edges_sql('l', 'feature')})
    SELECT feature, coalesce(CAST({bin_sql()} AS INTEGER), 0) AS bin, count(*) AS n FROM l JOIN e USING (feature) GROUP BY ALL""",
)
def _(spark, sf):
    placed = bins.bin_assign(sample(spark, sf), FEATURES, digits=6)
    return placed.groupBy("feature", F.coalesce("bin", F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


_SHARES = "SELECT {k}, l_linenumber AS bin, count(*) / sum(count(*)) OVER (PARTITION BY {k}) AS share FROM lineitem WHERE {w} GROUP BY {k}, l_linenumber"


@query(
    "psi_proportions",
    f"""WITH a AS ({_SHARES.format(k='l_returnflag', w="l_linestatus = 'F'")}), b AS ({_SHARES.format(k='l_returnflag', w="l_linestatus = 'O'")})
    SELECT l_returnflag, round(sum((coalesce(a.share, 0) - coalesce(b.share, 0)) *
      ln((coalesce(a.share, 0) + 1e-10) / (coalesce(b.share, 0) + 1e-10))), 8) AS psi
    FROM a FULL JOIN b USING (l_returnflag, bin) GROUP BY l_returnflag""",
)
def _(spark, sf):
    t = table(spark, sf, "lineitem")

    def shares(status):
        from pyspark.sql import Window as W

        c = t.where(F.col("l_linestatus") == status).groupBy("l_returnflag", F.col("l_linenumber").alias("bin")).count()
        return c.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy("l_returnflag")))

    return rounded(stability.psi_proportions(shares("F"), shares("O"), ["l_returnflag"]), 8, "psi")


def _psi_cte(group: str, base: str, source: str) -> str:
    """Bin shares on the base edges, zero-filled, joined to the base shares."""
    return f"""e AS ({edges_sql(source, 'feature', where=base)}),
      g AS (SELECT feature, {group}, count(value) AS n FROM {source} GROUP BY feature, {group}),
      k AS (SELECT feature, unnest(range(1, coalesce(len(e), 1))) AS bin FROM e),
      c AS (SELECT feature, {group}, {bin_sql()} AS bin, count(*) AS c FROM {source} JOIN e USING (feature) GROUP BY ALL),
      h AS (SELECT g.feature, g.{group}, g.n, k.bin, coalesce(c.c, 0) AS c FROM g JOIN k USING (feature)
            LEFT JOIN c ON c.feature = g.feature AND c.{group} = g.{group} AND c.bin = k.bin),
      w AS (SELECT *, c / nullif(sum(c) OVER (PARTITION BY feature, {group}), 0) AS share FROM h),
      b AS (SELECT feature, bin, share AS bshare, n AS bn FROM w WHERE {base}),
      psi AS (SELECT w.feature, w.{group}, any_value(w.n) AS n,
          CASE WHEN any_value(w.n) >= 20 AND any_value(b.bn) >= 20 THEN
            sum((share - bshare) * ln((share + 1e-10) / (bshare + 1e-10))) END AS psi
        FROM w JOIN b USING (feature, bin) GROUP BY w.feature, w.{group})"""


MONTHLY_PSI = f"""WITH {S}, {LONG}, {_psi_cte('month', f"month = '{BASE_MONTH}'", 'l')}"""


@query(
    "monthly_psi",
    f"{MONTHLY_PSI} SELECT feature, month, n, CASE WHEN month = '{BASE_MONTH}' THEN 0 ELSE round(psi, 8) END AS psi FROM psi",
)
def _(spark, sf):
    return rounded(stability.monthly_psi(sample(spark, sf), "month", FEATURES, BASE_MONTH, digits=6), 8, "psi")


@query(
    "psi_alerts",
    f"""{MONTHLY_PSI} SELECT feature, round(max(psi), 8) AS max_psi FROM (SELECT feature, CASE WHEN month = '{BASE_MONTH}' THEN 0 ELSE psi END AS psi FROM psi)
    GROUP BY feature HAVING max(psi) > 0.02""",
)
def _(spark, sf):
    psi = stability.monthly_psi(sample(spark, sf), "month", FEATURES, BASE_MONTH, digits=6)
    return rounded(stability.psi_alerts(psi, 0.02), 8, "max_psi")


@query(
    "feature_psi",
    f"""WITH {S}, u AS (SELECT *, CASE WHEN dt < DATE '2000-01-01' THEN 'base' ELSE 'actual' END AS side FROM s),
      l AS ({long_sql('u', ['side'])}), {_psi_cte('side', "side = 'base'", 'l')}
    SELECT feature, round(psi, 8) AS psi FROM psi WHERE side = 'actual'""",
)
def _(spark, sf):
    s = sample(spark, sf)
    dev = project.split_slice(s, "dt", ("19900101", "19991231"))
    oot = project.split_slice(s, "dt", ("20000101", "20991231"))
    return rounded(stability.feature_psi(dev, oot, FEATURES, digits=6), 8, "psi")


def iv_cte(keys: str, label: str = "y", source: str = "l", n_bins: int = 10) -> str:
    """Evidence per (keys, bin) in ``v``."""
    return f"""f AS (SELECT * FROM {source} WHERE {label} IS NOT NULL AND value IS NOT NULL),
      e AS ({edges_sql('f', keys, n_bins=n_bins)}),
      c AS (SELECT {keys}, {bin_sql()} AS bin, count(*) FILTER ({label} = 0) AS n_good, count(*) FILTER ({label} = 1) AS n_bad
            FROM f JOIN e USING ({keys}) GROUP BY ALL),
      v AS (SELECT *, ln(good_share / bad_share) AS woe, (good_share - bad_share) * ln(good_share / bad_share) AS iv_part
        FROM (SELECT {keys}, bin, n_good, n_bad,
            greatest(n_good / nullif(sum(n_good) OVER (PARTITION BY {keys}), 0), 1e-4) AS good_share,
            greatest(n_bad / nullif(sum(n_bad) OVER (PARTITION BY {keys}), 0), 1e-4) AS bad_share FROM c))"""


@query(
    "feature_iv",
    f"WITH {S}, {LONG}, {iv_cte('feature')} SELECT feature, round(sum(iv_part), 8) AS iv FROM v GROUP BY feature",
)
def _(spark, sf):
    return rounded(iv.feature_iv(sample(spark, sf), "y", FEATURES, digits=6), 8, "iv")


@query(
    "feature_alerts",
    f"""{MONTHLY_PSI}, {iv_cte('feature').replace(' e AS', ' ie AS').replace('JOIN e', 'JOIN ie').replace('c AS (SELECT feature, CASE', 'ic AS (SELECT feature, CASE').replace('FROM c)', 'FROM ic)')}
    SELECT feature, 'unstable' AS alert, round(max(psi), 8) AS value FROM psi WHERE month <> '{BASE_MONTH}' GROUP BY feature HAVING max(psi) > 0.02
    UNION ALL SELECT feature, 'leakage', round(sum(iv_part), 8) FROM v GROUP BY feature HAVING sum(iv_part) > 0.0003
    UNION ALL SELECT feature, 'missing', round(1 - count(value) / count(*), 8) FROM l GROUP BY feature HAVING 1 - count(value) / count(*) > 0.06""",
)
def _(spark, sf):
    s = sample(spark, sf)
    psi = stability.monthly_psi(s, "month", FEATURES, BASE_MONTH, digits=6)
    ivs = iv.feature_iv(s, "y", FEATURES, digits=6)
    coverage = unpivot_features(s, [], FEATURES).groupBy("feature").agg(
        F.avg(F.col("value").isNotNull().cast("double")).alias("coverage")
    )
    return rounded(stability.feature_alerts(psi, ivs, coverage, 0.02, 0.0003, 0.06), 8, "value")


@query(
    "woe_table",
    f"""WITH {S}, {LONG}, {iv_cte('feature')} SELECT feature, CAST(bin AS INTEGER) AS bin, n_good, n_bad, round(good_share, 8) AS good_share,
      round(bad_share, 8) AS bad_share, round(woe, 8) AS woe, round(iv_part, 10) AS iv_part FROM v""",
)
def _(spark, sf):
    w = iv.woe_table(sample(spark, sf), "y", FEATURES, digits=6)
    return rounded(rounded(w, 8, "good_share", "bad_share", "woe"), 10, "iv_part")


@query(
    "monthly_iv",
    f"""WITH {S}, {LONG}, {iv_cte('month, feature')}
    SELECT month, feature, round(sum(iv_part) FILTER (bin IS NOT NULL), 8) AS iv FROM v GROUP BY month, feature""",
)
def _(spark, sf):
    return rounded(iv.monthly_iv(sample(spark, sf), "y", FEATURES, "month", digits=6), 8, "iv")


@query(
    "feature_stability",
    f"""{MONTHLY_PSI}, {iv_cte('month, feature').replace(' e AS', ' ie AS').replace('JOIN e', 'JOIN ie').replace('c AS (SELECT month, feature, CASE', 'ic AS (SELECT month, feature, CASE').replace('FROM c)', 'FROM ic)')}
    SELECT p.feature, p.month, p.n, CASE WHEN p.month = '{BASE_MONTH}' THEN 0 ELSE round(p.psi, 8) END AS psi, i.iv
    FROM psi p LEFT JOIN (SELECT month, feature, round(sum(iv_part) FILTER (bin IS NOT NULL), 8) AS iv FROM v GROUP BY month, feature) i
      ON p.feature = i.feature AND p.month = i.month""",
)
def _(spark, sf):
    s = sample(spark, sf)
    return rounded(feature_cube.feature_stability(s, "y", "month", FEATURES, BASE_MONTH, digits=6), 8, "psi", "iv")


@query(
    "histogram_iv",
    f"""WITH {S}, {LONG}, f AS (SELECT * FROM l WHERE y IS NOT NULL AND value IS NOT NULL),
      q AS (SELECT feature, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM f GROUP BY feature),
      c AS (SELECT feature, greatest(1, least(20, CAST(floor((value - lo) / ((hi - lo) / 20.0)) AS BIGINT) + 1)) AS bin,
            count(*) FILTER (y = 0) AS g, count(*) FILTER (y = 1) AS b FROM f JOIN q USING (feature) GROUP BY ALL),
      v AS (SELECT feature, greatest(g / sum(g) OVER (PARTITION BY feature), 1e-4) AS gs, greatest(b / sum(b) OVER (PARTITION BY feature), 1e-4) AS bs FROM c)
    SELECT feature, round(sum((gs - bs) * ln(gs / bs)), 8) AS iv FROM v GROUP BY feature""",
)
def _(spark, sf):
    return rounded(iv.histogram_iv(sample(spark, sf), "y", FEATURES, bounds="exact"), 8, "iv")


OVERVIEW = f"""WITH {S} SELECT count(*) AS total_samples, count(*) FILTER (y = 1) AS positive_samples, count(*) FILTER (y = 0) AS negative_samples,
      round(count(*) FILTER (y = 1) / count(*), 6) AS positive_rate, min(dt) AS first_day, max(dt) AS last_day,
      count(DISTINCT dt) AS n_days, count(*) FILTER (uid IS NULL) AS null_ids, count(*) FILTER (y IS NULL) AS null_labels,
      count(*) FILTER (dt IS NULL) AS null_days, count(DISTINCT uid) AS n_users,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT uid, dt FROM s)) AS duplicate_rows FROM s"""


@query("sample_overview", OVERVIEW)
def _(spark, sf):
    return profile.sample_overview(sample(spark, sf), "uid", "dt", "y")


SEGMENTS = f"""WITH {S} SELECT strftime(dt, '%Y%m') AS month, count(*) AS samples, count(*) FILTER (y = 1) AS positive,
      round(count(*) FILTER (y = 1) / count(*), 6) AS positive_rate,
      round(CASE WHEN count(*) FILTER (y = 0) = 0 THEN CASE WHEN count(*) FILTER (y = 1) > 0 THEN 0.0 END
        ELSE count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1) END, 2) AS neg_per_pos FROM s GROUP BY 1"""


@query("label_segments", SEGMENTS)
def _(spark, sf):
    return profile.label_segments(sample(spark, sf), "dt", "y")


@query(
    "label_stability",
    f"""SELECT max(positive_rate) AS rate_max, min(positive_rate) AS rate_min, round((max(positive_rate) - min(positive_rate)) * 100, 2) AS volatility_pp,
      round(stddev_pop(positive_rate) * 100, 2) AS std_pp,
      CASE WHEN round((max(positive_rate) - min(positive_rate)) * 100, 2) < 1 THEN 'stable'
        WHEN round((max(positive_rate) - min(positive_rate)) * 100, 2) < 3 THEN 'slight' ELSE 'significant' END AS verdict,
      first(month ORDER BY positive_rate, month) AS lowest_month, first(month ORDER BY positive_rate DESC, month) AS highest_month
    FROM ({SEGMENTS})""",
)
def _(spark, sf):
    return profile.label_stability(profile.label_segments(sample(spark, sf), "dt", "y"))


@query(
    "sample_sufficiency",
    f"""SELECT CASE WHEN positive_samples >= 10000 AND total_samples >= 100000 THEN 'ample'
        WHEN positive_samples >= 500 AND total_samples >= 50000 THEN 'usable' ELSE 'insufficient' END AS verdict,
      positive_samples >= 10000 AS enough_positives, positive_samples AS positive_count, total_samples >= 50000 AS enough_rows,
      total_samples AS total_count FROM ({OVERVIEW})""",
)
def _(spark, sf):
    return profile.sample_sufficiency(profile.sample_overview(sample(spark, sf), "uid", "dt", "y"))


@query(
    "split_summary",
    f"""WITH {S}, t AS (SELECT *, {SPLIT_TAG} AS split FROM s)
    SELECT split, count(*) AS rows, coalesce(sum(y), 0) AS positives, round(coalesce(sum(y), 0) / count(*), 8) AS positive_rate,
      min(dt) AS first_day, max(dt) AS last_day, round(count(*) / sum(count(*)) OVER (), 8) AS share
    FROM t WHERE split IS NOT NULL GROUP BY split""",
)
def _(spark, sf):
    return rounded(profile.split_summary(sample(spark, sf), "dt", "y", SPLITS), 8, "positive_rate", "share")
