"""Which rows and which features go into a model.

Row selections that keep "the k first by some order" find the k-th order value and filter on it, so the
table itself is never sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.functions.dates import date_column
from riskspark.functions.values import holds_personal_number, null_if_nan, to_number
from riskspark.operators.bins import unpivot_features
from riskspark.operators.feature_cube import missing_iv_psi
from riskspark.operators.ranks import rank_threshold

# Filter limits and the drop share per separability of development and out-of-time rows.
MISSING_LIMIT, IV_FLOOR, PSI_CEILING, LEAK_CORRELATION = 0.95, 0.015, 0.2, 0.99
OLDEST_WEIGHT = 0.2
DROP_TIERS = ((0.6, 0.0), (0.7, 0.05), (0.8, 0.08))
DROP_TOP = 0.12
# Cuts of a stratified split are sent to every task up to this many label values; beyond, they are joined by shuffle.
BROADCAST_STRATA = 500_000


def full_scheme(df: DataFrame) -> DataFrame:
    return df.withColumn("weight", F.lit(1.0))


def _month(df: DataFrame, dt: str) -> Column:
    return F.date_format(date_column(df, dt), "yyyyMM")


def recent_n(df: DataFrame, dt: str, n_months: int) -> DataFrame:
    """Rows of the last ``n_months`` distinct months; undated rows drop, no dated row is an error."""
    dated = df.withColumn("__m", _month(df, dt)).where(F.col("__m").isNotNull())
    if dated.isEmpty():
        raise ValueError(f"no value of {dt} is a date")
    months = dated.select("__m").distinct().orderBy(F.desc("__m")).limit(n_months)
    return dated.join(F.broadcast(months), "__m", "left_semi").drop("__m")  # n_months rows


def time_weight(df: DataFrame, dt: str) -> DataFrame:
    """Weight rising linearly from 0.2 (first month present) to 1.0 (last); undated rows weigh 1."""
    month = _month(df, dt)
    months = df.select(F.sort_array(F.collect_set(month))).scalar()  # distinct months only
    last = F.size(F.col("__ms")) - F.lit(1)
    place = F.array_position(F.col("__ms"), F.col("__m")) - F.lit(1)
    rise = F.lit(1.0 - OLDEST_WEIGHT) * place / last + F.lit(OLDEST_WEIGHT)
    weight = F.when(F.col("__m").isNull() | (last < 1), F.lit(1.0)).otherwise(rise)
    return df.withColumns({"__m": month, "__ms": months}).withColumn("weight", weight).drop("__m", "__ms")


def hash_order(columns: Sequence[str], seed: int) -> Column:
    """60-bit position of a row in a seeded pseudo-random order, reproducible in any SQL with md5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def drop_share(separability: float, base: float = 0.05) -> float:
    """Share of development rows to drop for an adversarial AUC."""
    for limit, share in DROP_TIERS:
        if separability < limit:
            return base if share == 0.05 else share
    return DROP_TOP


def _beyond(columns: Sequence[str], threshold: Column) -> Column:
    """Row tuple > threshold tuple; true when there is no threshold or the row has no value."""
    later = F.lit(False)
    for c in reversed(list(columns)):
        later = (F.col(c) > threshold[c]) | ((F.col(c) == threshold[c]) & later)
    return F.coalesce(threshold.isNull() | later, F.lit(True))


def _with_cut(df: DataFrame, cut: DataFrame) -> DataFrame:
    """Attach a one-row table as ``__cut``. The generator keeps the optimizer from repeating its subquery."""
    return df.withColumn("__cut", F.explode(F.array(cut.scalar())))


def adversarial_drop(df: DataFrame, proba: str, pct: float, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Drop the ``round(n·pct)`` rows with the lowest probability of being out-of-time.

    Rows without a probability (null or NaN) count in n and stay. ``tie_cols`` (numeric, never null) order
    equal probabilities.
    """
    order = ["__p", *tie_cols]
    rows = df.withColumn("__p", to_number(F.col(proba)))
    total = df.select(F.count(F.lit(1))).scalar()
    last = F.least(F.bround(total * F.lit(float(pct))).cast("bigint"), F.col("n")) - 1
    cut = rank_threshold(rows.where(F.col("__p").isNotNull()), [], order, last).select("cut")
    return _with_cut(rows, cut).where(_beyond(order, F.col("__cut"))).drop("__cut", "__p")


def importance_cut(importance: DataFrame, pct: float = 95.0) -> DataFrame:
    """Features by falling gain up to and including the one that crosses ``pct`` of the total gain."""
    everything = W.partitionBy(F.lit(1))  # one row per feature
    before = everything.orderBy(F.desc("total_gain"), "feature").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("total_gain").over(everything)
    reached = F.coalesce(F.sum("total_gain").over(before), F.lit(0.0)) / total * 100
    return (
        importance.withColumn("cum_before", reached).withColumn("__total", total)
        .where((F.col("__total") <= 0) | (F.col("cum_before") <= pct))
        .drop("__total")
    )


def adversarial_features(importance: DataFrame, features: DataFrame, top_k: int) -> DataFrame:
    """Feature list without the ``top_k`` features that best tell development from out-of-time rows."""
    top = importance.orderBy(F.desc("total_gain"), "feature").limit(top_k).select("feature")
    return features.join(F.broadcast(top), "feature", "left_anti")


def adversarial_top_k(n_features: int) -> int:
    return max(3, int(n_features * 0.15))


def iv_psi_filter(
    dev: DataFrame, oot: DataFrame, features: Sequence[str], label: str,
    missing_limit: float = MISSING_LIMIT, iv_floor: float = IV_FLOOR, psi_ceiling: float = PSI_CEILING,
    digits: int | None = None,
) -> DataFrame:
    """Per feature: missing rate, IV, PSI(dev→oot) and whether it is kept. A null IV or PSI does not drop.

    A listed feature that either table lacks cannot be judged: it is kept, with nulls.
    """
    absent = [f for f in features if f not in dev.columns or f not in oot.columns]
    features = [f for f in features if f not in absent]
    table = missing_iv_psi(dev, oot, features, label, digits=digits)
    drop = (
        (F.col("missing_rate") >= missing_limit)
        | F.coalesce(F.col("iv") < iv_floor, F.lit(False))
        | F.coalesce(F.col("psi") > psi_ceiling, F.lit(False))
    )
    judged = table.select(
        "feature", F.round("missing_rate", 6).alias("missing_rate"), F.round("iv", 6).alias("iv"),
        F.round("psi", 6).alias("psi"), (~drop).alias("kept"),
    )
    unjudged = [(f, None, None, None, True) for f in absent]
    return judged.union(dev.sparkSession.createDataFrame(unjudged, judged.schema)) if absent else judged


def safety_filter(
    df: DataFrame, features: Sequence[str], id_col: str | None = None, label: str | None = None,
    missing_limit: float = MISSING_LIMIT, leak_limit: float = LEAK_CORRELATION,
) -> DataFrame:
    """``(feature, reason)`` with a null reason for kept features; one pass over all checked columns."""
    fixed: dict[str, str] = {}
    for f in features:
        if f == id_col:
            fixed[f] = "id_col"
        elif f not in df.columns:
            fixed[f] = "missing_column"
        else:
            if holds_personal_number(f):
                fixed[f] = "sensitive_column"
    checked = [f for f in features if f not in fixed]
    y = to_number(F.col(label)) if label and label in df.columns else F.lit(None).cast("double")
    rows = df.select(y.alias("__y"), *[to_number(F.col(f)).alias(f) for f in checked])
    long = unpivot_features(rows, ["__y"], checked)
    x, y = F.col("value"), F.col("__y")
    both = x.isNotNull() & y.isNotNull()
    stats = long.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.avg(x.isNull().cast("double")).alias("missing"),
        F.bool_and(F.when(both, x == y)).alias("same"),
        F.count_distinct(F.when(both, y)).alias("classes"),
        F.min(F.when(both, x)).alias("x_lo"), F.max(F.when(both, x)).alias("x_hi"),
        F.covar_pop(F.when(both, x), F.when(both, y)).alias("cov"),
        F.stddev_pop(F.when(both, x)).alias("sx"), F.stddev_pop(F.when(both, y)).alias("sy"),
    ).withColumn("r", F.try_divide(F.col("cov"), F.col("sx") * F.col("sy")))
    reason = (
        F.when(F.col("lo").isNull() | (F.col("lo") == F.col("hi")), "constant")
        .when(F.col("missing") >= missing_limit, "high_missing")
        .when(F.col("same") & (F.col("classes") == 2), "leak_equal")
        .when(F.col("x_lo") == F.col("x_hi"), "constant")
        .when(F.abs("r") >= leak_limit, "leak_high_corr")
    )
    out = stats.select("feature", reason.alias("reason"))
    if fixed:
        named = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("reason")) for f, r in fixed.items()])
        out = out.unionByName(df.sparkSession.range(1).select(F.inline(named)))
    return out


def stratified_split(
    df: DataFrame, label: str, key_cols: Sequence[str], train_ratio: float = 0.7, seed: int = 42,
    name: str = "part",
) -> DataFrame:
    """Tag rows ``train``/``val``, the same share of every label value (null is a value of its own).

    Rows are ordered by a seeded hash of ``key_cols``; rows with equal keys stay together. With a label
    value that occurs once the split is not stratified; that check is an aggregation run up front, which also counts the
    values: a cut per value goes to every task, so that the rows of a frequent label are not dealt by label.
    """
    kind = dict(df.dtypes)[label]
    value = null_if_nan(F.col(label)) if kind in ("double", "float") else F.col(label)
    rows = df.withColumns({"__s": value, "__h": hash_order(key_cols, seed)})
    least, strata = rows.groupBy("__s").count().agg(F.min("count"), F.count(F.lit(1))).first()
    if least == 1:
        rows = rows.withColumn("__s", F.lit(None).cast(kind))
    # Decimal, so that a share ending in .5 rounds up whatever its binary form.
    last = F.round(F.col("n") * F.lit(Decimal(str(train_ratio)))).cast("bigint") - 1
    cuts = rank_threshold(rows, ["__s"], ["__h"], last).select(
        F.col("__s").alias("__stratum"), F.col("cut.__h").alias("__cut")
    )
    if least == 1 or strata <= BROADCAST_STRATA:
        cuts = F.broadcast(cuts)
    tagged = rows.join(cuts, F.col("__s").eqNullSafe(F.col("__stratum")), "left")
    part = F.when(F.col("__h") <= F.col("__cut"), "train").otherwise("val")
    return tagged.withColumn(name, part).drop("__s", "__h", "__stratum", "__cut")


def negative_downsample(
    df: DataFrame, label: str, per_positive: float, key_cols: Sequence[str], seed: int = 42
) -> DataFrame:
    """All positives and the first ``per_positive`` × positives negatives in a seeded hash order."""
    rows = df.where(F.col(label).isin(0, 1)).withColumn("__h", hash_order(key_cols, seed))
    positives = rows.select(F.count_if(F.col(label) == 1)).scalar()
    last = F.floor(positives * F.lit(float(per_positive))).cast("bigint") - 1
    negatives = rows.where(F.col(label) == 0)
    cut = rank_threshold(negatives, [], ["__h"], F.least(last, F.col("n") - 1)).select("cut.__h")
    keep = (F.col(label) == 1) | (F.col("__h") <= F.col("__cut"))
    return _with_cut(rows, cut).where(keep).drop("__h", "__cut")
