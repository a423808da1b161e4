"""Sample overview, label distribution and feature distribution, whole-period and by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.functions.dates import date_column
from riskspark.operators.bins import unpivot_features
from riskspark.operators.project import split_tag
from riskspark.operators.quantiles import exact_quantiles
from riskspark.spec import SplitSpec

# Limits of the verdicts below.
STABLE_PP, SLIGHT_PP = 1.0, 3.0
AMPLE = (10_000, 100_000)
USABLE = (500, 50_000)
DISTRIBUTION_QUANTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)


def safe_rate(part: Column, whole: Column) -> Column:
    """Ratio rounded to 6 digits, 0 for an empty whole."""
    return F.coalesce(F.round(F.try_divide(part, whole), 6), F.lit(0.0))


def monthly_label_rate(df: DataFrame, month: str, labels: Sequence[str]) -> DataFrame:
    """Per month × label: rows with a label, rows with label 1, their rate."""
    long = df.select(month, *[F.col(c).cast("double").alias(c) for c in labels]).unpivot(
        [month], list(labels), "label", "y"
    )
    total, overdue = F.count("y"), F.count_if(F.col("y") == 1)
    return long.groupBy(month, "label").agg(
        total.alias("total"), overdue.alias("overdue"), safe_rate(overdue, total).alias("rate")
    )


def feature_distribution(
    df: DataFrame, features: Sequence[str], quantiles: Sequence[float] = DISTRIBUTION_QUANTILES,
    method: str = "exact",
) -> DataFrame:
    """Per feature: coverage, mean, min, max and quantiles (``q01`` … ``q99``) over all rows."""
    long = unpivot_features(df, [], features)
    base = [
        F.avg(F.col("value").isNotNull().cast("double")).alias("coverage"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    names = [f"q{round(p * 100):02d}" for p in quantiles]
    if method == "approx":
        sketch = F.percentile_approx("value", list(quantiles), 10000).alias("q")
        table = long.groupBy("feature").agg(*base, sketch)
    else:
        q = exact_quantiles(long, ["feature"], "value", quantiles, len(features)).select("feature", "q")
        table = long.groupBy("feature").agg(*base).join(F.broadcast(q), "feature", "left")
    return table.select(
        "feature", "coverage", "mean", "min", "max",
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(names)],
    )


def monthly_feature_stats(df: DataFrame, month: str, features: Sequence[str]) -> DataFrame:
    """Per month × feature: coverage, mean, min, max, sample deviation, distinct values.

    The distinct count makes Spark aggregate by (feature, month, value) first, with partial moments beside it: a value that
    fills a third of a month is one row a task in that shuffle.
    """
    long = unpivot_features(df, [month], features)
    return long.groupBy("feature", month).agg(
        F.avg(F.col("value").isNotNull().cast("double")).alias("coverage"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("std"),
        F.count_distinct("value").alias("n_unique"),
    )


def sample_overview(df: DataFrame, id_col: str, dt: str, label: str) -> DataFrame:
    """One row: sizes, label counts, date range, nulls per role, distinct users, duplicate (id, date) rows."""
    cells = (
        df.select(F.col(id_col).alias("id"), date_column(df, dt).alias("day"), F.col(label).alias("y"))
        .groupBy("id", "day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("y") == 1).alias("pos"),
            F.count_if(F.col("y") == 0).alias("neg"),
            F.count_if(F.col("y").isNull()).alias("no_label"),
        )
    )
    total, pos, neg = F.sum("n"), F.sum("pos"), F.sum("neg")
    return cells.agg(
        total.alias("total_samples"),
        pos.alias("positive_samples"),
        neg.alias("negative_samples"),
        safe_rate(pos, total).alias("positive_rate"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count_distinct("day").alias("n_days"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("null_ids"),
        F.sum("no_label").alias("null_labels"),
        F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("n"))), F.lit(0)).alias("null_days"),
        F.count_distinct("id").alias("n_users"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
    )


def label_segments(df: DataFrame, dt: str, label: str) -> DataFrame:
    """Per ``YYYYMM``: rows, positives, rate over all rows, negatives per positive."""
    month = F.date_format(date_column(df, dt), "yyyyMM").alias("month")
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    samples = F.count(F.lit(1))
    return df.groupBy(month).agg(
        samples.alias("samples"),
        pos.alias("positive"),
        safe_rate(pos, samples).alias("positive_rate"),
        F.round(F.when(neg == 0, F.when(pos > 0, F.lit(0.0))).otherwise(neg / F.greatest(pos, F.lit(1))), 2).alias(
            "neg_per_pos"
        ),
    )


def label_stability(segments: DataFrame, month: str = "month", rate: str = "positive_rate") -> DataFrame:
    """Spread of the monthly rate in percentage points, verdict, and the extreme months (first of ties)."""
    low, high = F.min(rate), F.max(rate)
    spread = F.round((high - low) * 100, 2)
    return segments.agg(
        high.alias("rate_max"),
        low.alias("rate_min"),
        spread.alias("volatility_pp"),
        F.round(F.stddev_pop(rate) * 100, 2).alias("std_pp"),
        F.when(spread < STABLE_PP, "stable").when(spread < SLIGHT_PP, "slight").otherwise("significant").alias("verdict"),
        F.min(F.struct(F.col(rate).alias("r"), F.col(month).alias("m"))).getField("m").alias("lowest_month"),
        F.min(F.struct((-F.col(rate)).alias("r"), F.col(month).alias("m"))).getField("m").alias("highest_month"),
    )


def sample_sufficiency(overview: DataFrame) -> DataFrame:
    """Is the sample large enough: ample, usable or insufficient."""
    pos, total = F.col("positive_samples"), F.col("total_samples")
    return overview.select(
        F.when((pos >= AMPLE[0]) & (total >= AMPLE[1]), "ample")
        .when((pos >= USABLE[0]) & (total >= USABLE[1]), "usable")
        .otherwise("insufficient")
        .alias("verdict"),
        (pos >= AMPLE[0]).alias("enough_positives"),
        pos.alias("positive_count"),
        (total >= USABLE[1]).alias("enough_rows"),
        total.alias("total_count"),
    )


def split_summary(df: DataFrame, dt: str, label: str, splits: SplitSpec) -> DataFrame:
    """Per split: rows, positives, rate, date range and share of all split rows."""
    tagged = split_tag(df, dt, splits).select(
        "split", date_column(df, dt).alias("day"), F.col(label).alias("y")
    )
    table = tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("y").cast("double"), F.lit(0.0)).alias("positives"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )
    # One row per split name: the window sees a handful of rows.
    everything = W.partitionBy(F.lit(1))
    return table.select(
        "split", "rows", "positives",
        (F.col("positives") / F.col("rows")).alias("positive_rate"),
        "first_day", "last_day",
        (F.col("rows") / F.sum("rows").over(everything)).alias("share"),
    )
