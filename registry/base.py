"""The credit-like sample view on ``lineitem``, in Spark and in SQL, and SQL building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark import SplitSpec

FEATURES = ["qty", "price", "disc", "tax"]
SPLITS = SplitSpec(
    {
        "train": ("1995-01-01", "1998-12-31"),
        "test": ("1999-01-01", "1999-12-31"),
        "oot": ("2000-01-01", "2001-11-30"),
    }
)
OOT_MONTHS = ("2000-01", "2001-11")
MODELS = {"new": "score_new", "old": "score_old"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, date, month, two labels, four features (two with gaps) and two scores (one with gaps)."""
    t = table(spark, sf_dir, "lineitem")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    return t.select(
        F.col("l_suppkey").alias("uid"),
        F.col("l_shipdate").cast("date").alias("dt"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.when(flag == "R", 1.0).when(flag == "A", 0.0).alias("y"),
        (F.col("l_linestatus") == "F").cast("double").alias("y2"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.0)).alias("disc"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.round(F.lit(0.02) + F.lit(0.015) * F.col("l_quantity") + F.col("l_discount"), 6).alias("score_new"),
        F.when(line != 7, F.round(F.lit(0.9) - F.col("l_extendedprice") / F.lit(150000.0), 6)).alias("score_old"),
        F.col("l_orderkey").alias("okey"),
        F.col("l_partkey").alias("pkey"),
        line.alias("line"),
    )


S = """s AS (
  SELECT l_suppkey AS uid, CAST(l_shipdate AS DATE) AS dt, strftime(l_shipdate, '%Y-%m') AS month,
    CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS DOUBLE) AS y,
    CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS y2,
    l_quantity AS qty, l_extendedprice AS price,
    nullif(l_discount, 0) AS disc, nullif(l_tax, 0) AS tax,
    round(CAST(0.02 AS DOUBLE) + CAST(0.015 AS DOUBLE) * l_quantity + l_discount, 6) AS score_new,
    CASE WHEN l_linenumber <> 7 THEN round(CAST(0.9 AS DOUBLE) - l_extendedprice / 150000.0, 6) END AS score_old,
    l_orderkey AS okey, l_partkey AS pkey, l_linenumber AS line
  FROM lineitem)"""
ALL = ["okey", "pkey", "line", "uid", "dt", "month", "y", "y2", "qty", "price", "disc", "tax", "score_new", "score_old"]

SPLIT_TAG = """CASE WHEN dt BETWEEN DATE '1995-01-01' AND DATE '1998-12-31' THEN 'train'
    WHEN dt BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'test'
    WHEN dt BETWEEN DATE '2000-01-01' AND DATE '2001-11-30' THEN 'oot' END"""
OOT = "month BETWEEN '2000-01' AND '2001-11'"


def long_sql(source: str, keep: Sequence[str], features: Sequence[str] = FEATURES, where: str = "TRUE") -> str:
    keys = "".join(f"{k}, " for k in keep)
    return " UNION ALL ".join(
        f"SELECT {keys}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {where}" for f in features
    )


def edges_sql(source: str, keys: str, value: str = "value", n_bins: int = 10, where: str = "TRUE",
              min_rows: int | None = None) -> str:
    """(keys, n, e): sorted distinct edges, inner ones rounded to 6 digits; null when degenerate."""
    ps = ", ".join(f"{k / n_bins!r}" for k in range(1, n_bins))
    need = 2 * n_bins if min_rows is None else min_rows
    return f"""
      SELECT {keys}, n, CASE WHEN n >= {need} AND lo < hi THEN
          list_sort(list_distinct(list_concat([lo], [greatest(lo, least(hi, round(x, 6))) for x in q], [hi]))) END AS e
      FROM (SELECT {keys}, count({value}) AS n, min({value}) AS lo, max({value}) AS hi,
              quantile_cont({value}, [{ps}]) AS q
            FROM {source} WHERE {value} IS NOT NULL AND ({where}) GROUP BY {keys})"""


def bin_sql(value: str = "value", edges: str = "e") -> str:
    return (
        f"CASE WHEN {value} BETWEEN {edges}[1] AND {edges}[-1] "
        f"THEN greatest(1, len([x for x in {edges} if x < {value}])) END"
    )


def rank_sql(source: str, keys: Sequence[str], score: str, label: str, where: str = "TRUE") -> str:
    """(keys, n, n_bad, auc, ks, gini) as a sub-select."""
    g = ", ".join(keys)
    pre = f"{g}, " if g else ""
    part = f"PARTITION BY {g}" if g else ""
    group = f"GROUP BY {g}" if g else ""
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
      SELECT {pre}n, n_bad, auc, CASE WHEN n_bad > 0 AND n_bad < n THEN gap END AS ks, abs(2 * auc - 1) AS gini
      FROM (SELECT {pre}CAST(max(p) + max(g) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS n_bad,
              CASE WHEN max(p) > 0 AND max(g) > 0 THEN
                sum(CAST(bad AS DOUBLE) * (gb + 0.5 * CAST(good AS DOUBLE))) / (CAST(max(p) AS DOUBLE) * max(g)) END AS auc,
              max(abs((bb + bad) / nullif(CAST(p AS DOUBLE), 0) - (gb + good) / nullif(CAST(g AS DOUBLE), 0))) AS gap
            FROM (SELECT {pre}bad, good,
                    CAST(coalesce(sum(good) OVER ({part} ORDER BY s {before}), 0) AS DOUBLE) AS gb,
                    CAST(coalesce(sum(bad) OVER ({part} ORDER BY s {before}), 0) AS DOUBLE) AS bb,
                    sum(bad) OVER ({part}) AS p, sum(good) OVER ({part}) AS g
                  FROM (SELECT {pre}{score} AS s, count(*) FILTER ({label} > 0) AS bad,
                          count(*) FILTER ({label} <= 0) AS good
                        FROM {source} WHERE {score} IS NOT NULL AND {label} IS NOT NULL AND ({where})
                        GROUP BY {pre}{score}))
            {group})"""


def pairs_sql(source: str, keep: Sequence[str], labels: Sequence[str] = ("y", "y2"), where: str = "TRUE") -> str:
    keys = "".join(f"{k}, " for k in keep)
    return " UNION ALL ".join(
        f"SELECT {keys}'{m}' AS model, '{lab}' AS label, {c} AS score, {lab} AS y FROM {source} "
        f"WHERE {c} IS NOT NULL AND {lab} IS NOT NULL AND ({where})"
        for m, c in MODELS.items()
        for lab in labels
    )


def sql_round(value: Column, digits: int) -> Column:
    """``round`` of a double as the SQL engine computes it: scaled, rounded to a whole number away from zero, scaled back.

    Spark's own rounds the shortest decimal text instead, so 0.285 goes to 0.29 there and to 0.28 in SQL.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: sql_round(F.col(c), digits) for c in columns})
