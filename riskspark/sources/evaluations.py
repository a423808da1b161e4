"""Collecting the evaluation JSON files of many model runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_METRICS = "struct<n:bigint,positive:bigint,label_rate:double,auc:double,ks:double,gini:double,psi_oot:double>"
EVAL_SCHEMA = (
    f"splits struct<train:{_METRICS},val:{_METRICS},oot:{_METRICS},all:{_METRICS}>, "
    "algo string, features bigint, optimistic_bias boolean"
)


def collect_evaluations(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per run directory matched by e.g. ``/runs/*/evaluation/eval.json``, or held by a folder such as ``/runs``.

    The schema is given, so no inference pass opens every file twice. A pattern is expanded by the driver; the folders
    below a named one are listed by tasks, which suits many thousands of runs.
    """
    raw = spark.read.schema(EVAL_SCHEMA).json(pattern, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    run = F.element_at(F.split(F.input_file_name(), "/"), -3)
    return raw.select(
        F.url_decode(run).alias("run"),
        "algo",
        F.col("features").alias("n_features"),
        F.coalesce("optimistic_bias", F.lit(False)).alias("optimistic_bias"),
        *[
            F.col(f"splits.{split}.{metric}").alias(f"{split}_{metric}")
            for split in ("train", "val", "oot")
            for metric in ("auc", "ks", "n")
        ],
        F.col("splits.oot.psi_oot").alias("psi_oot"),
    )


def join_run_specs(specs: DataFrame, evaluations: DataFrame, run: str = "run") -> DataFrame:
    """Planned runs with their results; a run without an evaluation keeps its row.

    ``status`` is ``failed`` for failed specs, ``missing_eval`` without a file, otherwise ``done``.
    """
    both = specs.withColumnRenamed("status", "__s").join(evaluations.drop("algo"), run, "left")
    failed = F.col("__s") == "failed"
    no_file = F.col("optimistic_bias").isNull()
    status = F.when(failed, "failed").when(no_file, "missing_eval").otherwise("done")
    metric = [c for c in evaluations.columns if c.endswith(("_auc", "_ks", "_n", "psi_oot"))]
    return both.select(
        *[c for c in specs.columns if c != "status"],
        status.alias("status"),
        F.when(~failed, F.col("optimistic_bias")).alias("optimistic_bias"),
        *[F.when(~failed, F.col(c)).alias(c) for c in metric],
    )
