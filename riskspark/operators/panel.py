"""Procedures on panel samples (one user in many periods)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskspark.operators.validate import require_columns


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def score_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", check: bool = True
) -> DataFrame:
    """Combine score tables on their full key (user and date). A repeated key on the right is an error.

    Joining on the user alone multiplies rows; ``check`` guards against exactly that.
    """
    require_columns(left, keys)
    require_columns(right, keys)
    if len(keys) < 2:
        raise ValueError("join score tables on user and date, not on the user alone")
    if check and not duplicate_keys(right, keys).isEmpty():
        raise ValueError(f"right side repeats {list(keys)}")
    return left.join(right, list(keys), how)


def label_join(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Attach a user-level label table; the planner broadcasts it when it is small."""
    return features.join(labels, key, "left")


def panel_stickiness(df: DataFrame, id_col: str, period: str, label: str) -> DataFrame:
    """Users, periods per user, and the share of multi-period users whose label never changes.

    Collapsed to (user, period, label) before the per-user step, so a user with a third of the rows is
    reduced map-side; distinct counts per user are then sums over distinct rows.
    """
    cells = df.select(
        F.col(id_col).alias("id"), F.col(period).alias("p"), F.col(label).cast("double").alias("y")
    ).where(F.col("id").isNotNull()).groupBy("id", "p").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    users = cells.groupBy("id").agg(
        F.count("p").alias("periods"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    several = F.col("periods") > 1
    labelled = several & F.col("lo").isNotNull()
    constant = labelled & (F.col("lo") == F.col("hi"))
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("periods").alias("periods_per_user"),
        F.count_if(several).alias("multi_period_users"),
        F.count_if(constant).alias("constant_label_users"),
        F.try_divide(F.count_if(constant), F.count_if(labelled)).alias("constant_share"),
    )


def label_maturity(df: DataFrame, month: str, label: str) -> DataFrame:
    """Share of rows without a label yet, per month."""
    missing = F.col(label).isNull()
    return df.groupBy(month).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("unlabelled"),
        F.avg(missing.cast("double")).alias("unlabelled_share"),
    )
