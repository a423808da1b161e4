"""Weight of evidence and information value (IV) of features against a 0/1 label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.operators.bins import attach_edges, bin_index, quantile_edges, unpivot_features
from riskspark.operators.quantiles import exact_quantiles

# Fixed value: smallest bin share used in a ratio.
SHARE_FLOOR = 1e-4


def _labelled(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    rows = df.where(F.col(label).isNotNull()).withColumn("__y", F.col(label).cast("double"))
    return unpivot_features(rows, [*keys, "__y"], features).where(F.col("value").isNotNull())


def _evidence(binned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-bin counts, shares and evidence of single rows."""
    return evidence(
        binned.groupBy(*keys, "bin").agg(
            F.count_if(F.col("__y") == 0).alias("n_good"), F.count_if(F.col("__y") == 1).alias("n_bad")
        ),
        keys,
    )


def evidence(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shares and evidence of ``(keys…, bin, n_good, n_bad)``; shares are over the bins of the group."""
    group = W.partitionBy(*keys)

    def share(c: str) -> Column:
        part = F.try_divide(F.col(c), F.sum(c).over(group))
        return F.when(part.isNotNull(), F.greatest(part, F.lit(SHARE_FLOOR)))

    shared = counts.withColumns({"good_share": share("n_good"), "bad_share": share("n_bad")})
    woe = F.log(F.col("good_share") / F.col("bad_share"))
    return shared.withColumn("woe", woe).withColumn(
        "iv_part", (F.col("good_share") - F.col("bad_share")) * F.col("woe")
    )


def woe_table(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    keys: Sequence[str] = (),
    n_bins: int = 10,
    digits: int | None = None,
    method: str = "exact",
) -> DataFrame:
    """``(keys…, feature, bin, n_good, n_bad, good_share, bad_share, woe, iv_part)``."""
    long = _labelled(df, label, features, keys)
    group = [*keys, "feature"]
    edges = quantile_edges(long, group, n_bins=n_bins, digits=digits, method=method, groups=None if keys else len(features))
    # Only features are bounded by the call; the number of key groups is the data's.
    placed = attach_edges(long, edges, group, None if keys else len(features), n_bins).withColumn(
        "bin", bin_index("value", "edges", n_bins)
    )
    # Groups without edges keep one null bin, so that they show up with a null IV.
    return _evidence(placed, group)


def total_iv(table: DataFrame, group: Sequence[str]) -> DataFrame:
    part = F.when(F.col("bin").isNotNull(), F.col("iv_part"))
    return table.groupBy(*group).agg(F.sum(part).alias("iv"))


def feature_iv(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    n_bins: int = 10,
    digits: int | None = None,
    method: str = "exact",
) -> DataFrame:
    """IV per feature; null with too few rows, one distinct value or one class."""
    return total_iv(woe_table(df, label, features, (), n_bins, digits, method), ["feature"])


def monthly_iv(
    df: DataFrame, label: str, features: Sequence[str], month: str, n_bins: int = 10, digits: int | None = None
) -> DataFrame:
    """IV per (feature, month), with edges of their own for every month."""
    return total_iv(woe_table(df, label, features, [month], n_bins, digits), [month, "feature"])


def histogram_iv(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    n_bins: int = 20,
    bounds: str = "approx",
    tails: tuple[float, float] = (0.01, 0.99),
) -> DataFrame:
    """Two-phase IV for very large tables: fix P1/P99 bounds, then count fixed-width bins in one pass.

    Values outside the bounds fall into the first or last bin. ``bounds="exact"`` selects the two
    percentiles exactly instead of reading them off a sketch.
    """
    long = _labelled(df, label, features, ())
    if bounds == "exact":
        q = exact_quantiles(long, ["feature"], "value", list(tails), len(features)).select("feature", "q")
    else:
        q = long.groupBy("feature").agg(F.percentile_approx("value", list(tails), 10000).alias("q"))
    fitted = F.broadcast(  # one row per listed feature
        q.select("feature", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(n_bins))
    slot = F.floor((F.col("value") - F.col("lo")) / width) + F.lit(1)
    placed = long.join(fitted, "feature").withColumn(
        "bin",
        F.when(F.col("hi") > F.col("lo"), F.greatest(F.lit(1), F.least(F.lit(n_bins), slot))),
    )
    return total_iv(_evidence(placed, ["feature"]), ["feature"])
