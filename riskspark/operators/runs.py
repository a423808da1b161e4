"""Tables of model runs: ranking, best of each kind, diagnosis, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions.values import to_number
from riskspark.operators.ranks import ranked

# Limits of the diagnosis and of the comparisons.
GAP_OVERFIT, GAP_UNDERFIT, LOW_TRAIN_AUC = 0.05, 0.005, 0.70
CONVERGED_SHARE, PSI_WARN = 0.95, 0.10
METRIC_TOLERANCE = 5e-4
MEAN_TOLERANCE = (30.0, 0.03)
NOISE = (0.005, 5000)


def leaderboard(runs: DataFrame, run: str = "run", metric: str = "oot_auc") -> DataFrame:
    """1-based rank by falling metric, missing (null or NaN) metrics last, ties by the whole run id."""
    order = {
        "__k": F.coalesce(-to_number(F.col(metric)), F.lit(float("inf"))),
        "__n": F.col(run).isNull().cast("int"),
        "__t": F.coalesce(F.col(run), F.lit("" if dict(runs.dtypes)[run] == "string" else 0)),
    }
    placed = ranked(runs.withColumns(order), [], list(order), "__before")
    return placed.withColumn("rank", F.col("__before") + 1).drop("__before", *order)


def top_runs(runs: DataFrame, k: int, run: str = "run", metric: str = "oot_auc", done: Column | None = None) -> DataFrame:
    """The ``k`` best finished runs: those with a metric, or those where ``done`` holds, missing metrics last."""
    value = to_number(F.col(metric))
    return runs.where(value.isNotNull() if done is None else done).orderBy(value.desc_nulls_last(), run).limit(k)


def best_per_algo(runs: DataFrame, algo: str = "algo", run: str = "run", metric: str = "oot_auc") -> DataFrame:
    """Best finished run of each algorithm; an aggregation, so a dominant algorithm is reduced map-side."""
    rest = [c for c in runs.columns if c != algo]
    best = F.min_by(F.struct(*rest), F.struct((-F.col(metric)).alias("m"), F.col(run).alias("r")))
    picked = runs.where(to_number(F.col(metric)).isNotNull()).groupBy(algo).agg(best.alias("b"))
    return picked.select(algo, *[F.col(f"b.{c}").alias(c) for c in rest])


def diagnose_runs(
    runs: DataFrame, train_auc: str = "train_auc", oot_auc: str = "oot_auc",
    best_iter: str | None = None, n_estimators: str | None = None, psi: str | None = None,
) -> DataFrame:
    """Add ``status`` (first hit) and ``reasons`` (all hits, comma-separated)."""
    train, oot = F.col(train_auc), F.col(oot_auc)
    gap = train - oot
    over = gap > GAP_OVERFIT
    under = ~over & ((gap < GAP_UNDERFIT) | (train < LOW_TRAIN_AUC))
    hits: list[tuple[str, Column]] = [("overfit", over), ("underfit", under)]
    if best_iter and n_estimators:
        hits.append(("underconverged", F.try_divide(F.col(best_iter), F.col(n_estimators)) >= CONVERGED_SHARE))
    if psi:
        hits.append(("unstable_psi", F.col(psi) > PSI_WARN))
    found = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits]))
    return runs.withColumn("__found", found).withColumns(
        {
            "status": F.coalesce(F.get("__found", F.lit(0)), F.lit("well_fit")),
            "reasons": F.array_join("__found", ","),
            "train_oot_gap": gap,
        }
    ).drop("__found")


def metric_reconcile(
    reported: DataFrame, computed: DataFrame, keys: list[str], value: str = "value",
    tolerance: float | None = METRIC_TOLERANCE,
) -> DataFrame:
    """Reported against computed values on their full key: ``ok``, ``differs`` or ``not_computed``.

    ``tolerance=None`` compares means of score-card points, within the larger of 30 points and 3 %.
    """
    both = reported.select(*keys, F.col(value).alias("reported")).join(
        computed.select(*keys, F.col(value).alias("computed")), keys, "left"
    )
    delta = F.abs(F.col("reported") - F.col("computed"))
    points, share = MEAN_TOLERANCE
    allowed = F.greatest(F.lit(points), F.lit(share) * F.abs("computed")) if tolerance is None else F.lit(tolerance)
    status = F.when(F.col("computed").isNull(), "not_computed").when(delta <= allowed, "ok").otherwise("differs")
    return both.select(*keys, "reported", "computed", delta.alias("delta"), status.alias("status"))


def noise_pairs(left: DataFrame, right: DataFrame, keys: list[str], metric: str = "auc", n: str = "n") -> DataFrame:
    """Compare two versions run by run: a delta under 0.005 on fewer than 5 000 rows is noise."""
    both = left.select(*keys, F.col(metric).alias("m1"), F.col(n).alias("n1")).join(
        right.select(*keys, F.col(metric).alias("m2"), F.col(n).alias("n2")), keys
    )
    delta, size = F.col("m2") - F.col("m1"), F.least("n1", "n2")
    noise = (F.abs(delta) < NOISE[0]) & (size < NOISE[1])
    return both.select(
        *keys, delta.alias("delta"), size.alias("n"),
        F.when(noise, "noise").when(delta > 0, "better").when(delta < 0, "worse").otherwise("equal").alias("verdict"),
    )
