"""Readers and writers as round trips through the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from registry import QUERIES, SQL, q_selection, query  # noqa: F401
from registry.base import FEATURES, S, sample, table
from riskspark.operators import bins, project, stability
from riskspark.sources import evaluations, samples
from riskspark.sources.staging import stage, staging_dir


def _folder(spark) -> str:
    return f"{staging_dir(spark).rstrip('/')}/riskspark-{uuid.uuid4().hex}"


@query(
    "csv_to_monthly_parquet",
    f"""WITH {S} SELECT concat('m', month) AS month, count(*) AS n, count(disc) AS n_disc, round(sum(price), 2) AS price, CAST(min(okey) AS BIGINT) AS first_key
    FROM s GROUP BY month""",
)
def _(spark, sf):
    """CSV → Parquet → Parquet by month → read back."""
    base = _folder(spark)
    rows = sample(spark, sf).select("okey", F.concat(F.lit("m"), "month").alias("month"), *FEATURES)
    rows.write.csv(f"{base}/s.csv", header=True)
    typed = samples.convert_to_parquet(spark, f"{base}/s.csv", f"{base}/s.parquet")
    samples.write_sample(typed, f"{base}/m.parquet", "month")
    back = samples.read_sample(spark, f"{base}/m.parquet")
    return back.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count("disc").alias("n_disc"), F.round(F.sum("price"), 2).alias("price"),
        F.min("okey").cast("long").alias("first_key"),
    )


@query(
    "sample_outline",
    "SELECT DISTINCT 'ship_date' AS date, strftime(l_shipdate, '%Y-%m') AS month, 'dpd30_x' AS labels, 'score_new' AS scores FROM lineitem",
)
def _(spark, sf):
    """Roles by name and all months of the first column that holds dates."""
    rows = sample(spark, sf).select(F.col("uid").cast("string").alias("ser_no"), F.col("dt").alias("ship_date"), F.col("y").alias("dpd30_x"), "score_new")
    o = samples.outline_sample(rows)
    months = spark.createDataFrame([(m,) for m in o.months], "month string")
    return months.select(
        F.lit(o.date).alias("date"), "month", F.lit(",".join(o.labels)).alias("labels"), F.lit(",".join(o.scores)).alias("scores")
    )


@query(
    "evaluation_files",
    """SELECT concat('run=', l_suppkey) AS run, 'gbt' AS algo, CAST(count(*) AS BIGINT) AS train_n, round(avg(l_discount), 6) AS oot_auc,
      FALSE AS optimistic_bias FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf):
    """One JSON file per run, collected again."""
    base = _folder(spark)
    runs = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_discount"), 6).alias("auc")
    )
    empty = {m: F.lit(None) for m in ("train", "oot")}
    splits = F.struct(*[F.struct("n", (F.col("auc") if s == "oot" else F.lit(0.5)).alias("auc")).alias(s) for s in empty])
    files = runs.select(splits.alias("splits"), F.lit("gbt").alias("algo"), F.lit("evaluation").alias("part"), "run")
    # A fixed number of tasks: the rows are few bytes, so their partitions would be merged to one, and each row is a file.
    # Tasks move their own files into place; the folder is new and read only after the job has ended.
    dealt = files.repartition(4 * spark.sparkContext.defaultParallelism, "run").write.partitionBy("run", "part")
    dealt.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(base)
    got = evaluations.collect_evaluations(spark, base)
    return got.select("run", "algo", "train_n", "oot_auc", "optimistic_bias")


@query("feature_list_file", f"SELECT feature AS feature_name FROM ({SQL['iv_psi_filter']}) WHERE kept")
def _(spark, sf):
    """Features that the missing, IV and PSI filter keeps over the whole table, written as a list and read back."""
    base = _folder(spark)
    kept = [r["feature"] for r in QUERIES["iv_psi_filter"](spark, sf).where("kept").collect()]  # at most the listed features
    samples.write_feature_list(spark, kept, f"{base}/f.csv")
    return spark.createDataFrame([(f,) for f in samples.read_feature_list(spark, f"{base}/f.csv")], "feature_name string")


@query("table_columns_file", "SELECT * FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) t(feature_name) WHERE (SELECT count(*) FROM lineitem) > 0")
def _(spark, sf):
    """Columns of the file's footer between two names, without those that hold no value in the whole table."""
    columns = project.interval_features(samples.read_sample_columns(spark, f"{sf}/lineitem.parquet"), "l_quantity", "l_tax")
    held = table(spark, sf, "lineitem").agg(*[F.count(c).alias(c) for c in columns])
    return held.unpivot([], columns, "feature_name", "n").where("n > 0").select("feature_name")


@query(
    "approx_edges",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, TRUE AS within_bound" for f in FEATURES),
)
def _(spark, sf):
    """Edges read off a sketch: every inner edge's rank is within a thousandth of the rows of its aim, ties allowed."""
    long = stage(bins.unpivot_features(sample(spark, sf), [], FEATURES)).where(F.col("value").isNotNull())
    edges = bins.quantile_edges(long, ["feature"], method="approx")
    inner = edges.select("feature", F.explode(F.slice("edges", 2, F.size("edges") - 2)).alias("edge"))
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    per_edge = counts.join(F.broadcast(inner.withColumnRenamed("feature", "f")), F.col("feature") == F.col("f")).groupBy("feature", "edge").agg(
        F.sum(F.when(F.col("value") < F.col("edge"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("edge"), F.col("n")).otherwise(0)).alias("upto"), F.sum("n").alias("all"),
    )
    slack = F.col("all") * 0.001 + 1
    aims = F.exists(
        F.sequence(F.lit(1), F.lit(9)),
        lambda k: (k * F.col("all") / 10 >= F.col("below") - slack) & (k * F.col("all") / 10 <= F.col("upto") + slack),
    )
    return per_edge.withColumn("ok", aims).groupBy("feature").agg(F.bool_and("ok").alias("within_bound"))


@query(
    "monthly_psi_unsmoothed",
    f"""WITH {S}, f AS (SELECT DISTINCT month FROM s) SELECT feature, month, month = '2000-01' AS is_base, TRUE AS not_below_smoothed
    FROM f, (VALUES {", ".join(f"('{x}')" for x in FEATURES)}) t(feature)""",
)
def _(spark, sf):
    """Empty bins unsmoothed: infinite or as large as the smoothed value, and zero for the base month."""
    s = stage(sample(spark, sf).select("month", *FEATURES))
    raw = stability.monthly_psi(s, "month", FEATURES, "2000-01", zero_bin="inf").select("feature", "month", F.col("psi").alias("raw"))
    both = raw.join(stability.monthly_psi(s, "month", FEATURES, "2000-01"), ["feature", "month"])
    near = F.coalesce((F.col("raw") == float("inf")) | (F.abs(F.col("raw") - F.col("psi")) < 1e-6), F.col("psi").isNull() & F.col("raw").isNull())
    return both.select("feature", "month", (F.col("month") == "2000-01").alias("is_base"), near.alias("not_below_smoothed"))
