"""Probability, log-odds and score-card arithmetic as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# They must equal the published score-card scale for results to agree.
BASE_POINTS = 400.0
POINTS_TO_DOUBLE_ODDS = 35.0
PROBABILITY_FLOOR = 1e-6
LOGIT_LIMIT = 30.0
SANE_POINTS = (400.0, 780.0)

POINTS_FACTOR = POINTS_TO_DOUBLE_ODDS / math.log(2.0)


def clip(col: Column, low: float, high: float) -> Column:
    """Clamp; null stays null (``greatest``/``least`` alone would replace it by the bound)."""
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))


def log_odds(probability: Column) -> Column:
    p = clip(probability.cast("double"), PROBABILITY_FLOOR, 1.0 - PROBABILITY_FLOOR)
    return F.log(p / (F.lit(1.0) - p))


def calibrated_probability(odds: Column, coef: float, intercept: float) -> Column:
    z = clip(odds * F.lit(float(coef)) + F.lit(float(intercept)), -LOGIT_LIMIT, LOGIT_LIMIT)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scorecard_points(probability: Column) -> Column:
    """High points mean low risk."""
    return F.lit(BASE_POINTS) - F.lit(POINTS_FACTOR) * log_odds(probability)
