"""Equal-frequency edges and bin assignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions.values import null_if_nan
from riskspark.operators.quantiles import BROADCAST_NUMBERS, exact_quantiles
from riskspark.operators.ranks import quoted
from riskspark.sources.staging import stage

def unpivot_features(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Long rows ``(keep…, feature, value)``; one pass, features as doubles, NaN as null."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    long = typed.unpivot(list(keep), list(features), "feature", "value")
    return long.select(*keep, "feature", null_if_nan(F.col("value")).alias("value"))


def probabilities(n_bins: int) -> list[float]:
    return [k * (1.0 / n_bins) for k in range(n_bins)] + [1.0]


def edges_of(q: DataFrame, keys: Sequence[str], n_bins: int, digits: int | None, min_rows: int | None = None) -> DataFrame:
    """``(keys…, n, edges)`` from a table of quantiles ``q`` at ``probabilities(n_bins)``, see ``quantile_edges``."""
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(n_bins))

    def inner(k: int) -> Column:
        edge = F.get("q", F.lit(k))
        return edge if digits is None else F.greatest(low, F.least(high, F.round(edge, digits)))

    edges = F.array_distinct(F.array(low, *[inner(k) for k in range(1, n_bins)], high))
    enough = F.col("n") >= F.lit(2 * n_bins if min_rows is None else min_rows)
    return q.select(*keys, "n", F.when(enough & (low < high), edges).alias("edges"))


def quantile_edges(
    long: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    n_bins: int = 10,
    digits: int | None = None,
    method: str = "exact",
    min_rows: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """``(keys…, n, edges)``: quantiles at k/n_bins without repeats.

    Edges are null with fewer than ``min_rows`` (default 2·n_bins) values or a single distinct value.
    ``digits`` rounds the inner edges. ``method="approx"`` reads the quantiles off a bounded sketch in
    one pass, for tables too wide to select ranks exactly. ``groups`` is a proven bound on the number of key groups.
    """
    if method == "approx":
        q = long.where(F.col(value).isNotNull()).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(value, probabilities(n_bins), 10000).alias("q")
        )
    else:
        q = exact_quantiles(long, keys, value, probabilities(n_bins), groups)
    return edges_of(q, keys, n_bins, digits, min_rows)


def bin_index(value: str, edges: str, n_bins: int) -> Column:
    """Right-closed bins 1…n with the lowest edge included; null outside the edges. Takes column names.

    A sum of comparisons rather than a higher-order function: it stays in generated code.
    """
    v, e = quoted(value), edges
    below = " + ".join(f"CASE WHEN get({e}, {i}) < {v} THEN 1 ELSE 0 END" for i in range(n_bins + 1))
    inside = f"{v} >= get({e}, 0) AND {v} <= element_at({e}, -1)"
    return F.expr(f"CASE WHEN {inside} THEN greatest(1, {below}) END")


def attach_edges(
    rows: DataFrame, edges: DataFrame, keys: Sequence[str], groups: int | None, n_bins: int
) -> DataFrame:
    """Join edge arrays onto rows. ``groups`` is a proven bound on the number of edge rows, null without one.

    Without a bound the edge table is written and counted first.
    """
    fitted = edges.select(*[F.col(k).alias(f"__{k}") for k in keys], "edges")
    if groups is None:
        fitted = stage(fitted)
        groups = fitted.count()
    if groups * (n_bins + 1) <= BROADCAST_NUMBERS:
        fitted = F.broadcast(fitted)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(fitted, same, "left").drop(*[f"__{k}" for k in keys])


def bin_assign(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), n_bins: int = 10, digits: int | None = None
) -> DataFrame:
    """Long rows with the equal-frequency bin of every feature value."""
    long = unpivot_features(df, keep, features)
    edges = quantile_edges(long, ["feature"], n_bins=n_bins, digits=digits, groups=len(features))
    placed = attach_edges(long, edges, ["feature"], len(features), n_bins)
    return placed.select(
        *keep, "feature", "value", bin_index("value", "edges", n_bins).alias("bin")
    )
