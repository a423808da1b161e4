"""Missing rates, IV and PSI of features off one table of bin counts.

Each measure has its own edges (labelled rows, base rows, one month), but all are selected together in two passes over one
unpivoted table, and one more pass bins every value by all of them at once. What comes out is a cube of a few hundred
counters per feature and group, which is written; the measures read nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.operators.bins import BROADCAST_NUMBERS, bin_index, edges_of, probabilities, unpivot_features
from riskspark.operators.iv import evidence, total_iv
from riskspark.operators.quantiles import quantiles_by_purpose
from riskspark.operators.stability import psi_of_counts
from riskspark.sources.staging import stage


def count_cube(
    long: DataFrame, keys: Sequence[str], purposes: Mapping[str, tuple[Column, Sequence[str]]], by: Sequence[str],
    n_bins: int = 10, digits: int | None = None, groups: int | None = None,
) -> DataFrame:
    """``(by…, bin_<p>, bins_<p>, n, present)``: rows and non-null values per cell, written once.

    A purpose is a condition on the rows its edges come from, and the keys (some of ``keys``) that its edges belong to:
    with fewer keys than ``keys`` the condition must pick one group of the others. ``bins_<p>`` is the number of bins the
    purpose has for the row's group, null without edges.
    """
    q = quantiles_by_purpose(long, keys, "value", probabilities(n_bins), {p: c for p, (c, _) in purposes.items()}, groups)
    edges = stage(edges_of(q, [*keys, "purpose"], n_bins, digits))
    small = groups if groups is not None else edges.count()
    placed = long
    for p, (_, own) in purposes.items():
        mine = edges.where(F.col("purpose") == p).select(*[F.col(k).alias(f"__{k}") for k in own], F.col("edges").alias(f"edges_{p}"))
        if small * (n_bins + 1) <= BROADCAST_NUMBERS:
            mine = F.broadcast(mine)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in own])
        placed = placed.join(mine, same, "left").drop(*[f"__{k}" for k in own])
    cells = [c for p in purposes for c in (bin_index("value", f"edges_{p}", n_bins).alias(f"bin_{p}"), (F.size(f"edges_{p}") - 1).alias(f"bins_{p}"))]
    names = [n for p in purposes for n in (f"bin_{p}", f"bins_{p}")]
    rows = placed.select(*by, "value", *cells)
    return stage(rows.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("present")))


def _iv(cube: DataFrame, group: Sequence[str]) -> DataFrame:
    labelled = cube.where(F.col("__y").isNotNull() & (F.col("present") > 0))
    counts = labelled.groupBy(*group, F.col("bin_iv").alias("bin")).agg(
        F.coalesce(F.sum(F.when(F.col("__y") == 0, F.col("present"))), F.lit(0)).alias("n_good"),
        F.coalesce(F.sum(F.when(F.col("__y") == 1, F.col("present"))), F.lit(0)).alias("n_bad"),
    )
    return total_iv(evidence(counts, group), group)


def _psi(cube: DataFrame, group: str, base: Column, n_bins: int, zero_bin: str, base_is_zero: bool) -> DataFrame:
    def held(bin_: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("bin_psi") == bin_, F.col("present"))), F.lit(0)).alias(f"c{bin_}")

    counts = cube.groupBy("feature", group).agg(
        F.sum("present").alias("n"),
        F.coalesce(F.sum(F.when(F.col("bin_psi").isNotNull(), F.col("present"))), F.lit(0)).alias("n_in"),
        F.max("bins_psi").alias("bins"),
        *[held(k) for k in range(1, n_bins + 1)],
    )
    return psi_of_counts(counts, group, base, n_bins, zero_bin, base_is_zero)


def feature_stability(
    df: DataFrame, label: str, month: str, features: Sequence[str], base_month: str, n_bins: int = 10,
    digits: int | None = None, zero_bin: str = "epsilon",
) -> DataFrame:
    """``(feature, month, n, psi, iv)``: PSI against the base month's bins, and IV on each month's own bins.

    The same values as ``stability.monthly_psi`` and ``iv.monthly_iv``; three passes over the table in all.
    """
    long = unpivot_features(df.withColumn("__y", F.col(label).cast("double")), [month, "__y"], features)
    is_base = F.col(month).eqNullSafe(F.lit(base_month))
    cube = count_cube(
        long, ["feature", month], {"iv": (F.col("__y").isNotNull(), ["feature", month]), "psi": (is_base, ["feature"])},
        ["feature", month, "__y"], n_bins, digits,
    )
    psi = _psi(cube, month, is_base, n_bins, zero_bin, True)
    ivs = _iv(cube, ["feature", month]).select(F.col("feature").alias("__f"), F.col(month).alias("__m"), "iv")
    same = (F.col("feature") == F.col("__f")) & F.col(month).eqNullSafe(F.col("__m"))
    return psi.join(ivs, same, "left").drop("__f", "__m")


def missing_iv_psi(
    dev: DataFrame, oot: DataFrame, features: Sequence[str], label: str, n_bins: int = 10, digits: int | None = None
) -> DataFrame:
    """``(feature, missing_rate, iv, psi)``: missing rate and IV of ``dev``, PSI from ``dev`` to ``oot``; three passes over both."""
    sides = [
        d.select(F.lit(side).alias("side"), y.alias("__y"), *features)
        for d, side, y in ((dev, "base", F.col(label).cast("double")), (oot, "actual", F.lit(None).cast("double")))
    ]
    long = unpivot_features(sides[0], ["side", "__y"], features).unionByName(unpivot_features(sides[1], ["side", "__y"], features))
    is_base = F.col("side") == "base"
    cube = count_cube(
        long, ["feature"], {"iv": (is_base & F.col("__y").isNotNull(), ["feature"]), "psi": (is_base, ["feature"])},
        ["feature", "side", "__y"], n_bins, digits, len(features),
    )
    ours = cube.where(is_base)
    missing = ours.groupBy("feature").agg(F.sum("n").cast("double").alias("all"), F.sum("present").alias("held")).select(
        "feature", ((F.col("all") - F.col("held")) / F.col("all")).alias("missing_rate")
    )
    psi = _psi(cube, "side", is_base, n_bins, "epsilon", False).where(F.col("side") == "actual").select("feature", "psi")
    return missing.join(_iv(ours, ["feature"]), "feature", "left").join(psi, "feature", "left")
