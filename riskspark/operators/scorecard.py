"""Calibration of a probability and its conversion to score-card points."""

from __future__ import annotations

import warnings

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from riskspark.functions.scores import SANE_POINTS, calibrated_probability, log_odds, scorecard_points
from riskspark.functions.values import to_number
from riskspark.operators.quantiles import exact_quantiles
from riskspark.operators.validate import require_columns
from riskspark.sources.staging import stage

# Inverse regularisation strength and the slope beyond which probabilities look degenerate.
INVERSE_STRENGTH = 20.0
STEEP_SLOPE = 8.0


def fit_calibration(df: DataFrame, proba: str, label: str) -> tuple[float, float]:
    """Slope and intercept of a logistic regression of the 0/1 label on the log-odds."""
    require_columns(df, [proba, label])
    rows = df.where(F.col(label).isin(0, 1) & to_number(F.col(proba)).isNotNull()).select(
        log_odds(F.col(proba)).alias("odds"), F.col(label).cast("double").alias("y")
    )
    vectors = VectorAssembler(inputCols=["odds"], outputCol="x").transform(rows)
    n = vectors.count()
    if n == 0:
        raise ValueError("no rows with a 0/1 label to calibrate on")
    # Spark averages the loss over rows, hence the penalty per row.
    model = LogisticRegression(
        featuresCol="x", labelCol="y", regParam=1.0 / (INVERSE_STRENGTH * n), elasticNetParam=0.0,
        standardization=False, maxIter=200, tol=1e-10,
    ).fit(vectors)
    coef, intercept = float(model.coefficients[0]), float(model.intercept)
    if coef <= 0:
        warnings.warn("slope <= 0: the probability runs against the label")
    elif coef > STEEP_SLOPE:
        warnings.warn("steep slope: the probabilities are very concentrated")
    return coef, intercept


def apply_scorecard(df: DataFrame, proba: str, coef: float, intercept: float) -> DataFrame:
    """Add ``odds``, ``logistic_prob`` and ``bscore``. Row-wise, so it also runs on a stream."""
    require_columns(df, [proba])
    return (
        df.withColumn("odds", log_odds(F.col(proba)))
        .withColumn("logistic_prob", calibrated_probability(F.col("odds"), coef, intercept))
        .withColumn("bscore", scorecard_points(F.col("logistic_prob")))
    )


def scorecard_summary(df: DataFrame, points: str = "bscore") -> DataFrame:
    """One row: size, range, mean, percentiles (2 digits), values out of the sane range or not finite.

    The points are computed and written once; the passes over them would otherwise repeat their logarithms in every clause.
    """
    df = stage(df.select(points))
    s = F.col(points)
    finite = s.isNotNull() & ~F.isnan(s) & (F.abs(s) < F.lit(float("inf")))
    cuts = (0.10, 0.25, 0.50, 0.75, 0.90)
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.min(s), 2).alias("bscore_min"),
        F.round(F.max(s), 2).alias("bscore_max"),
        F.round(F.avg(s), 2).alias("bscore_mean"),
        F.count_if(s < SANE_POINTS[0]).alias("below_range"),
        F.count_if(s > SANE_POINTS[1]).alias("above_range"),
        F.count_if(~finite).alias("not_finite"),
    )
    q = exact_quantiles(df, [], points, cuts).select("q").scalar()
    return stats.withColumn("__q", q).select(
        *stats.columns, *[F.round(F.get("__q", F.lit(i)), 2).alias(f"p{round(p * 100)}") for i, p in enumerate(cuts)]
    )
