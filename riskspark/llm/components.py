"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.sources.staging import stage


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its listed neighbours. Aggregated before the join, so hubs stay split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.select(F.col("u").alias("__u"), "m"), F.col("u") == F.col("__u")).select(
        "u", "v", F.least("u", "m").alias("m")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    told = _with_least(down)
    return told.select(F.col("v").alias("u"), F.col("m").alias("v")).union(told.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component; nodes without an edge to another are absent.

    ``edges`` has two long columns ``u`` and ``v``; loops and repeats do no harm. Each round is written to the
    shared checkpoint folder, and the rounds end when the edge set stays the same.
    """
    now = stage(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct())
    before = _mark(now)
    while True:
        step = _small_star(_large_star(now).distinct())
        now = stage(step.where(F.col("u") != F.col("v")).distinct())
        after = _mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
