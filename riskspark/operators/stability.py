"""Population stability index (PSI) of features over months or between two samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.operators.bins import attach_edges, bin_index, quantile_edges, unpivot_features

# Smoothing term and alert limit.
EPSILON = 1e-10
PSI_ALERT = 0.10
IV_LEAKAGE = 1.0
MISSING_LIMIT = 0.95


def psi_term(actual: Column, base: Column, epsilon: float = EPSILON) -> Column:
    return (actual - base) * F.log((actual + F.lit(epsilon)) / (base + F.lit(epsilon)))


def psi_proportions(
    actual: DataFrame, base: DataFrame, keys: Sequence[str] = (), bin_col: str = "bin", share: str = "share"
) -> DataFrame:
    """PSI of two tables of bin shares; a bin absent on one side counts as share 0."""
    on = [*keys, bin_col]
    both = actual.select(*on, F.col(share).alias("a")).join(
        base.select(*on, F.col(share).alias("b")), on, "full"
    )
    term = psi_term(F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0)))
    return both.groupBy(*keys).agg(F.sum(term).alias("psi"))


def _grouped_psi(
    long: DataFrame,
    group: str,
    base: Column,
    features: Sequence[str],
    n_bins: int,
    digits: int | None,
    zero_bin: str,
    base_is_zero: bool,
) -> DataFrame:
    edges = quantile_edges(long.where(base), ["feature"], n_bins=n_bins, digits=digits, groups=len(features))
    placed = attach_edges(long, edges, ["feature"], len(features), n_bins).withColumn(
        "bin", bin_index("value", "edges", n_bins)
    )
    # One row per (feature, group) with a counter per bin, so that empty bins need no grid.
    counts = placed.groupBy("feature", group).agg(
        F.count("value").alias("n"),
        F.count("bin").alias("n_in"),
        F.max(F.size("edges") - F.lit(1)).alias("bins"),
        *[F.count_if(F.col("bin") == k).alias(f"c{k}") for k in range(1, n_bins + 1)],
    )
    return psi_of_counts(counts, group, base, n_bins, zero_bin, base_is_zero)


def psi_of_counts(
    counts: DataFrame, group: str, is_base: Column, n_bins: int, zero_bin: str = "epsilon", base_is_zero: bool = False
) -> DataFrame:
    """``(feature, group, n, psi)`` from a row per (feature, group): ``n`` values, ``n_in`` of them inside the edges, the
    number of ``bins`` and a counter ``c1`` … per bin."""
    over = W.partitionBy("feature")
    counts = counts.withColumns(
        {f"b{k}": F.max(F.when(is_base, F.try_divide(f"c{k}", "n_in"))).over(over) for k in range(1, n_bins + 1)}
        | {"base_n": F.max(F.when(is_base, F.col("n"))).over(over)}
    )
    epsilon = 0.0 if zero_bin == "inf" else EPSILON
    terms = []
    for k in range(1, n_bins + 1):
        a, b = F.try_divide(F.col(f"c{k}"), F.col("n_in")), F.col(f"b{k}")
        term = psi_term(a, b, epsilon)
        if zero_bin == "inf":
            # Without smoothing a bin empty on one side is infinitely far from the other.
            term = F.when(((a == 0) | (b == 0)) & (a != b), F.lit(float("inf"))).when(a == b, F.lit(0.0)).otherwise(term)
        terms.append(F.when(F.col("bins") >= k, term).otherwise(F.lit(0.0)))
    enough = (F.col("n") >= 2 * n_bins) & (F.col("base_n") >= 2 * n_bins) & (F.col("bins") >= 1)
    psi = F.when(enough, reduce(lambda x, y: x + y, terms))
    if base_is_zero:
        psi = F.when(is_base, F.lit(0.0)).otherwise(psi)
    return counts.select("feature", group, "n", psi.alias("psi"))


def monthly_psi(
    df: DataFrame,
    month: str,
    features: Sequence[str],
    base_month: str,
    n_bins: int = 10,
    digits: int | None = None,
    zero_bin: str = "epsilon",
) -> DataFrame:
    """PSI of every (feature, month) against the base month's deciles; the base month is 0.

    ``zero_bin="inf"`` leaves empty bins unsmoothed, as the monthly profile does.
    """
    long = unpivot_features(df, [month], features)
    is_base = F.col(month).eqNullSafe(F.lit(base_month))
    return _grouped_psi(long, month, is_base, features, n_bins, digits, zero_bin, True)


def feature_psi(
    base: DataFrame, actual: DataFrame, features: Sequence[str], n_bins: int = 10, digits: int | None = None
) -> DataFrame:
    """PSI per feature of one sample against another."""
    sides = unpivot_features(base, [], features).withColumn("side", F.lit("base")).unionByName(
        unpivot_features(actual, [], features).withColumn("side", F.lit("actual"))
    )
    psi = _grouped_psi(sides, "side", F.col("side") == "base", features, n_bins, digits, "epsilon", False)
    return psi.where(F.col("side") == "actual").select("feature", "psi")


def psi_alerts(psi: DataFrame, limit: float = PSI_ALERT) -> DataFrame:
    """Features whose PSI exceeds the limit in any month."""
    return psi.groupBy("feature").agg(F.max("psi").alias("max_psi")).where(F.col("max_psi") > limit)


def feature_alerts(
    psi: DataFrame, iv: DataFrame, coverage: DataFrame,
    psi_limit: float = PSI_ALERT, iv_limit: float = IV_LEAKAGE, missing_limit: float = MISSING_LIMIT,
) -> DataFrame:
    """``(feature, alert, value)``: unstable in some month, suspiciously predictive, or almost empty.

    Takes the tables of ``monthly_psi``, ``feature_iv`` and ``feature_distribution``.
    """
    def rows(table: DataFrame, alert: str, value: Column, limit: float) -> DataFrame:
        return table.select("feature", F.lit(alert).alias("alert"), value.alias("value")).where(F.col("value") > limit)

    return (
        rows(psi_alerts(psi, psi_limit), "unstable", F.col("max_psi"), psi_limit)
        .unionByName(rows(iv, "leakage", F.col("iv"), iv_limit))
        .unionByName(rows(coverage, "missing", F.lit(1.0) - F.col("coverage"), missing_limit))
    )
