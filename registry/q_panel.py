"""Procedures on panel samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.base import S, rounded, sample, table
from riskspark.operators import panel


@query(
    "score_join",
    f"""WITH {S}, a AS (SELECT uid, dt, max(score_new) AS score_new FROM s GROUP BY uid, dt),
      b AS (SELECT uid, dt, min(score_old) AS score_old FROM s WHERE score_old IS NOT NULL GROUP BY uid, dt)
    SELECT uid, dt, score_new, score_old FROM a JOIN b USING (uid, dt)""",
)
def _(spark, sf):
    s = sample(spark, sf)
    new = s.groupBy("uid", "dt").agg(F.max("score_new").alias("score_new"))
    old = s.where(F.col("score_old").isNotNull()).groupBy("uid", "dt").agg(F.min("score_old").alias("score_old"))
    return panel.score_join(new, old, ["uid", "dt"])


@query(
    "label_join",
    """SELECT d.doc_id, d.lang, d.n_chars, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic")
    )
    return panel.label_join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), labels, "doc_id")


@query(
    "panel_stickiness",
    f"""WITH {S}, u AS (SELECT uid, count(DISTINCT month) AS k, min(y2) AS lo, max(y2) AS hi FROM s WHERE uid IS NOT NULL GROUP BY uid)
    SELECT count(*) AS users, round(avg(k), 8) AS periods_per_user, count(*) FILTER (k > 1) AS multi_period_users,
      count(*) FILTER (k > 1 AND lo = hi) AS constant_label_users,
      count(*) FILTER (k > 1 AND lo = hi) / nullif(count(*) FILTER (k > 1 AND lo IS NOT NULL), 0) AS constant_share FROM u""",
)
def _(spark, sf):
    return rounded(panel.panel_stickiness(sample(spark, sf), "uid", "month", "y2"), 8, "periods_per_user")


@query(
    "panel_stickiness_events",
    """WITH u AS (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS k, min(v) AS lo, max(v) AS hi
      FROM (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS v FROM events) WHERE user_id IS NOT NULL GROUP BY user_id)
    SELECT count(*) AS users, round(avg(k), 8) AS periods_per_user, count(*) FILTER (k > 1) AS multi_period_users,
      count(*) FILTER (k > 1 AND lo = hi) AS constant_label_users,
      count(*) FILTER (k > 1 AND lo = hi) / nullif(count(*) FILTER (k > 1 AND lo IS NOT NULL), 0) AS constant_share FROM u""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), (F.col("event_type") == "error").cast("int").alias("v")
    )
    return rounded(panel.panel_stickiness(e, "user_id", "day", "v"), 8, "periods_per_user")


@query(
    "label_maturity",
    f"""WITH {S} SELECT month, count(*) AS rows, count(*) FILTER (y IS NULL) AS unlabelled,
      round(count(*) FILTER (y IS NULL) / count(*), 8) AS unlabelled_share FROM s GROUP BY month""",
)
def _(spark, sf):
    return rounded(panel.label_maturity(sample(spark, sf), "month", "y"), 8, "unlabelled_share")


@query(
    "label_maturity_documents",
    """SELECT lang, count(*) AS rows, count(*) FILTER (quality IS NULL) AS unlabelled,
      round(count(*) FILTER (quality IS NULL) / count(*), 8) AS unlabelled_share
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""",
)
def _(spark, sf):
    docs = panel.label_join(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")
    return rounded(panel.label_maturity(docs, "lang", "quality"), 8, "unlabelled_share")
