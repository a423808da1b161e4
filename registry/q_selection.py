"""Sample and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry import query
from registry.base import FEATURES, S, long_sql, rounded, sample, table
from registry.q_profiling import _psi_cte, iv_cte
from riskspark.operators import project, select

_KEYS = ["okey", "pkey", "uid", "line"]
_HASH = "CAST('0x' || substr(md5(concat_ws('|', okey, pkey, uid, line, '42')), 1, 15) AS BIGINT)"
_ROW = [*_KEYS, "month", "y", "y2"]
_SEL = ", ".join(_ROW)


def _dev(spark, sf) -> DataFrame:
    return project.split_slice(sample(spark, sf), "dt", ("19950101", "19991231"))


def _oot(spark, sf) -> DataFrame:
    return project.split_slice(sample(spark, sf), "dt", ("20000101", "20011130"))


@query("full_scheme", f"WITH {S} SELECT {_SEL}, CAST(1 AS DOUBLE) AS weight FROM s")
def _(spark, sf):
    return select.full_scheme(sample(spark, sf).select(*_ROW))


@query(
    "recent_n",
    f"WITH {S} SELECT {_SEL}, dt FROM s WHERE month IN (SELECT DISTINCT month FROM s ORDER BY month DESC LIMIT 6)",
)
def _(spark, sf):
    return select.recent_n(sample(spark, sf).select(*_ROW, "dt"), "dt", 6)


@query(
    "time_weight",
    f"""WITH {S}, m AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS i, count(*) OVER () - 1 AS last FROM (SELECT DISTINCT month FROM s))
    SELECT month, count(*) AS n, round(any_value(CASE WHEN last > 0 THEN 0.8 * i / last + 0.2 ELSE 1.0 END), 8) AS weight FROM s JOIN m USING (month) GROUP BY month""",
)
def _(spark, sf):
    w = select.time_weight(sample(spark, sf), "dt")
    return w.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 8).alias("weight"))


_DROP = ["score_old", *_KEYS]


@query(
    "adversarial_drop",
    f"""WITH {S}, d AS (SELECT *, row_number() OVER (ORDER BY score_old NULLS LAST, {", ".join(_KEYS)}) AS k, count(*) OVER () AS n FROM s
      WHERE dt <= DATE '1999-12-31')
    SELECT {", ".join(_DROP)} FROM d WHERE k > round_even(n * 0.08, 0) OR score_old IS NULL""",
)
def _(spark, sf):
    dev = _dev(spark, sf).select(*_DROP)
    return select.adversarial_drop(dev, "score_old", select.drop_share(0.75), _KEYS)


# Gain per brand stands in for gain per feature: it comes from the tables and has a long tail.
_GAIN = """g AS (SELECT p_brand AS feature, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS total_gain
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)"""


def _gain(spark, sf) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("feature"))
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("feature").agg(F.sum("q").cast("double").alias("total_gain"))


@query(
    "importance_cut",
    f"""WITH {_GAIN}, c AS (SELECT *, coalesce(sum(total_gain) OVER (ORDER BY total_gain DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      / sum(total_gain) OVER () * 100 AS cum_before FROM g) SELECT feature, total_gain, round(cum_before, 8) AS cum_before FROM c WHERE cum_before <= 70""",
)
def _(spark, sf):
    return rounded(select.importance_cut(_gain(spark, sf), 70.0), 8, "cum_before")


@query(
    "adversarial_features",
    f"""WITH {_GAIN} SELECT DISTINCT p_brand AS feature FROM part WHERE p_brand NOT IN (SELECT feature FROM g ORDER BY total_gain DESC, feature LIMIT 3)""",
)
def _(spark, sf):
    features = table(spark, sf, "part").select(F.col("p_brand").alias("feature")).distinct()
    return select.adversarial_features(_gain(spark, sf), features, select.adversarial_top_k(20))


@query(
    "iv_psi_filter",
    f"""WITH {S}, u AS (SELECT *, CASE WHEN dt <= DATE '1999-12-31' THEN 'base' WHEN dt <= DATE '2001-11-30' THEN 'actual' END AS side FROM s),
      dev AS (SELECT * FROM u WHERE side = 'base'), lu AS (SELECT * FROM u WHERE side IS NOT NULL),
      lp AS ({long_sql('lu', ['side'])}), {_psi_cte('side', "side = 'base'", 'lp')},
      ld AS ({long_sql('dev', ['y'])}), {iv_cte('feature', 'y', 'ld').replace(' e AS', ' e2 AS').replace('JOIN e ', 'JOIN e2 ').replace('c AS (SELECT feature, CASE', 'c2 AS (SELECT feature, CASE').replace('FROM c)', 'FROM c2)')},
      iv AS (SELECT feature, sum(iv_part) AS iv FROM v GROUP BY feature),
      ms AS (SELECT feature, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM ld GROUP BY feature),
      ps AS (SELECT feature, psi FROM psi WHERE side = 'actual')
    SELECT feature, round(missing_rate, 6) AS missing_rate, round(iv, 6) AS iv, round(psi, 6) AS psi,
      NOT (missing_rate >= 0.06 OR coalesce(iv < 0.0003, FALSE) OR coalesce(psi > 0.2, FALSE)) AS kept
    FROM ms LEFT JOIN iv USING (feature) LEFT JOIN ps USING (feature)""",
)
def _(spark, sf):
    return select.iv_psi_filter(
        _dev(spark, sf), _oot(spark, sf), FEATURES, "y", missing_limit=0.06, iv_floor=0.0003, digits=6
    )


_SAFE = {
    "uid": "l_suppkey", "13812345678": "l_tax", "steady": "l_quantity * 0 + 3", "rare": "CASE WHEN l_quantity = 50 AND l_tax = 0.01 THEN l_discount END",
    "copy_y": "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END", "near_y": "CASE l_returnflag WHEN 'R' THEN 100 + l_tax ELSE l_tax END",
    "all_y": "CASE WHEN l_returnflag = 'N' THEN l_tax ELSE 7 END",
    "qty": "l_quantity", "flag_text": "l_linestatus",
}


@query(
    "safety_filter",
    """SELECT * FROM (VALUES ('uid', 'id_col'), ('gone', 'missing_column'), ('13812345678', 'sensitive_column')) AS t(feature, reason)
    UNION ALL """
    + " UNION ALL ".join(
        f"""SELECT '{f}', CASE WHEN count(DISTINCT x) <= 1 THEN 'constant' WHEN avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) >= 0.95 THEN 'high_missing'
          WHEN bool_and(x = y) AND count(DISTINCT y) FILTER (x IS NOT NULL) = 2 THEN 'leak_equal' WHEN count(DISTINCT x) FILTER (y IS NOT NULL) = 1 THEN 'constant'
          WHEN abs(corr(x, y)) >= 0.99 THEN 'leak_high_corr' END
        FROM (SELECT try_cast({e} AS DOUBLE) AS x, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS DOUBLE) AS y FROM lineitem)"""
        for f, e in _SAFE.items()
        if f not in ("uid", "13812345678")
    ),
)
def _(spark, sf):
    t = table(spark, sf, "lineitem").selectExpr(
        *[f"{e} AS `{f}`" for f, e in _SAFE.items()], "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS y"
    )
    return select.safety_filter(t, ["uid", "gone", *list(_SAFE)[1:]], "uid", "y")


@query(
    "stratified_split",
    f"""WITH {S}, h AS (SELECT *, {_HASH} AS h, y AS st FROM s WHERE dt <= DATE '1999-12-31'),
      k AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY h) AS i, count(*) OVER (PARTITION BY st) AS n FROM h),
      c AS (SELECT st, max(h) AS cut FROM k WHERE i <= round(n * 0.7) GROUP BY st)
    SELECT {_SEL}, CASE WHEN h <= cut THEN 'train' ELSE 'val' END AS part FROM h JOIN c ON h.st IS NOT DISTINCT FROM c.st""",
)
def _(spark, sf):
    return select.stratified_split(_dev(spark, sf).select(*_ROW), "y", _KEYS)


_RARE = "CASE WHEN line = 7 AND qty >= 45 THEN 1 ELSE 0 END"


@query(
    "negative_downsample",
    f"""WITH {S}, h AS (SELECT *, {_HASH} AS h, {_RARE} AS rare FROM s),
      k AS (SELECT *, row_number() OVER (PARTITION BY rare ORDER BY h) AS i, sum(rare) OVER () AS p FROM h),
      c AS (SELECT max(h) AS cut FROM k WHERE rare = 0 AND i <= p * 8)
    SELECT {_SEL}, CAST(rare AS INTEGER) AS rare FROM h, c WHERE rare = 1 OR h <= cut""",
)
def _(spark, sf):
    rows = sample(spark, sf).withColumn("rare", ((F.col("line") == 7) & (F.col("qty") >= 45)).cast("int"))
    return select.negative_downsample(rows.select(*_ROW, "rare"), "rare", 8, _KEYS)
