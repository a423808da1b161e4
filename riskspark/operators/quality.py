"""How well a score separates bad from good: AUC, KS, Gini, confusion counts, deciles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.functions.values import null_if_nan
from riskspark.operators.ranks import running_totals
from riskspark.operators.stability import feature_psi

_SCORE = "__score"


def _valid(df: DataFrame, score: str, label: str) -> DataFrame:
    s = F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """Bad (label > 0) and good rows per distinct score; everything rank-based reads only this.

    A row counts once, or as often as its column ``times`` says.
    """
    bad, good = F.col(label) > 0, F.col(label) <= 0
    counted = [F.count_if(c) if times is None else F.sum(F.when(c, F.col(times)).otherwise(F.lit(0))) for c in (bad, good)]
    return (
        _valid(df, score, label)
        .groupBy(*keys, F.col(score).cast("double").alias(_SCORE))
        .agg(counted[0].alias("bad"), counted[1].alias("good"))
    )


def metrics_from_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys…, n, n_bad, auc, ks, gini)``; the metrics are null when a group has one class only."""
    t = running_totals(counts, keys, [_SCORE], ["bad", "good"])
    bad, good = F.col("bad").cast("double"), F.col("good").cast("double")
    pairs = F.sum(bad * (F.col("before_good") + F.lit(0.5) * good))
    gap = F.abs(
        F.try_divide(F.col("before_bad") + bad, F.col("total_bad"))
        - F.try_divide(F.col("before_good") + good, F.col("total_good"))
    )
    table = t.groupBy(*keys).agg(
        F.max("total_bad").alias("n_bad"),
        F.max("total_good").alias("n_good"),
        pairs.alias("pairs"),
        F.max(gap).alias("gap"),
    )
    auc = F.try_divide(F.col("pairs"), F.col("n_bad").cast("double") * F.col("n_good").cast("double"))
    both = (F.col("n_bad") > 0) & (F.col("n_good") > 0)
    return table.select(
        *keys,
        (F.col("n_bad") + F.col("n_good")).alias("n"),
        "n_bad",
        auc.alias("auc"),
        F.when(both, F.col("gap")).alias("ks"),
        F.abs(F.lit(2.0) * auc - F.lit(1.0)).alias("gini"),
    )


def rank_metrics(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """AUC (ties count half), KS (once per distinct score) and Gini, per group."""
    return metrics_from_counts(score_counts(df, score, label, keys, times), keys)


def auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(df, score, label, keys).select(*keys, "n", "auc")


def ks(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(df, score, label, keys).select(*keys, "n", "ks")


def gini(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(df, score, label, keys).select(*keys, "n", "gini")


def confusion_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 at ``score >= threshold``, 6 digits, from one pass of counters."""
    hit, pos, neg = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1, F.col(label) == 0
    c = _valid(df, score, label).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hit & pos).alias("tp"),
        F.count_if(~hit & neg).alias("tn"),
        F.count_if(hit & neg).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
    )
    tp = F.col("tp").cast("double")
    precision = F.try_divide(tp, F.col("tp") + F.col("fp"))
    recall = F.try_divide(tp, F.col("tp") + F.col("fn"))
    f1 = F.when(
        (precision > 0) & (recall > 0), F.lit(2.0) * precision * recall / (precision + recall)
    )
    return c.select(
        *keys, "n", "tp", "tn", "fp", "fn",
        F.round(F.try_divide(tp + F.col("tn"), F.col("n")), 6).alias("accuracy"),
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(f1, 6).alias("f1"),
    )


def decile_table(
    df: DataFrame,
    score: str,
    label: str,
    keys: Sequence[str] = (),
    biz_cols: Sequence[str] = (),
    order_cols: Sequence[str] = (),
    n_bins: int = 10,
) -> DataFrame:
    """Buckets of equal width in row position by falling score; the top bucket has number ``n_bins``.

    Tied scores are ordered by ``order_cols`` (numeric), then label, then business columns. Rows equal in
    all of these are interchangeable, so they are collapsed first and split over buckets by arithmetic.
    """
    tie = list(dict.fromkeys([*order_cols, label, *biz_cols]))
    collapsed, order = _decile_counts(df, score, label, keys, tie)
    return _deciles(collapsed, order, label, keys, biz_cols, tie, n_bins)


def _decile_counts(
    df: DataFrame, score: str, label: str, keys: Sequence[str], tie: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Rows equal in score and tie columns as one row with a count ``c``, and the names of the order columns."""
    lowest = F.lit(float("-inf"))
    named = _valid(df, score, label).select(
        *keys,
        (-F.col(score).cast("double")).alias("__d"),
        *[F.coalesce(F.col(c).cast("double"), lowest).alias(f"__t{i}") for i, c in enumerate(tie)],
    )
    order = ["__d", *[f"__t{i}" for i in range(len(tie))]]
    return named.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("c")), order


def _deciles(
    collapsed: DataFrame, order: Sequence[str], label: str, keys: Sequence[str], biz_cols: Sequence[str],
    tie: Sequence[str], n_bins: int,
) -> DataFrame:
    """Decile table of weighted distinct scores: a count that crosses a bucket border is cut there."""
    lowest = F.lit(float("-inf"))
    t = running_totals(collapsed, keys, order, ["c"])
    first, last, n = F.col("before_c"), F.col("before_c") + F.col("c") - 1, F.col("total_c")

    def bucket(i: Column) -> Column:
        span = n - 1
        up = F.floor((i * n_bins + span - 1) / span)
        return F.when(span > 0, F.greatest(F.lit(1), up)).otherwise(F.lit((n_bins + 1) // 2))

    cut = F.col("cut")
    low = F.when(cut > 1, F.floor((cut - 1) * (n - 1) / n_bins) + 1).otherwise(F.lit(0))
    high = F.when(n > 1, F.floor(cut * (n - 1) / n_bins)).otherwise(F.lit(0))
    inside = F.least(last, high) - F.greatest(first, F.when(n > 1, low).otherwise(F.lit(0))) + 1
    spread = t.withColumn("cut", F.explode(F.sequence(bucket(first), bucket(last)))).withColumn("m", inside)
    value = {c: F.when(F.col(f"__t{i}") > lowest, F.col(f"__t{i}")) for i, c in enumerate(tie)}
    table = spread.where(F.col("m") > 0).groupBy(*keys, "cut").agg(
        F.sum("m").alias("count"),
        F.min(-F.col("__d")).alias("score_min"),
        F.max(-F.col("__d")).alias("score_max"),
        F.sum(value[label] * F.col("m")).alias("pos"),
        *[
            F.try_divide(
                F.sum(value[c] * F.col("m")), F.sum(F.when(value[c].isNotNull(), F.col("m")))
            ).alias(c)
            for c in biz_cols
        ],
    )
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))  # n_bins rows per group
    so_far = group.orderBy("cut").rowsBetween(W.unboundedPreceding, 0)
    rate = F.col("pos") / F.col("count")
    everyone = F.sum("pos").over(group)
    overall = everyone / F.sum("count").over(group)
    return table.select(
        *keys,
        (F.lit(n_bins + 1) - cut).cast("int").alias("decile"),
        "count",
        F.round("score_min", 4).alias("score_min"),
        F.round("score_max", 4).alias("score_max"),
        F.round(rate, 6).alias("label_rate"),
        F.round(F.try_divide(rate, overall), 4).alias("lift"),
        F.round(F.try_divide(F.col("pos"), everyone), 4).alias("recall"),
        F.round(F.try_divide(F.sum("pos").over(so_far), everyone), 4).alias("cum_recall"),
        *[F.round(c, 4).alias(c) for c in biz_cols],
    )


def split_evaluation(df: DataFrame, score: str, label: str, split: str) -> DataFrame:
    """Metrics per split plus an ``all`` row; ``all`` is added to the collapsed counts, not to the rows."""
    counts = score_counts(df, score, label, [split])
    both = counts.withColumn(split, F.explode(F.array(F.col(split), F.lit("all"))))
    merged = both.groupBy(split, _SCORE).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    m = metrics_from_counts(merged, [split])
    return m.select(
        split, "n", F.col("n_bad").alias("positive"),
        F.round(F.col("n_bad") / F.col("n"), 6).alias("label_rate"),
        *[F.round(c, 6).alias(c) for c in ("auc", "ks", "gini")],
    )


def split_deciles(
    df: DataFrame, score: str, label: str, split: str, biz_cols: Sequence[str] = ()
) -> DataFrame:
    """Decile table of every split and of ``all`` rows together, added to the collapsed counts, not to the rows."""
    tie = list(dict.fromkeys([label, *biz_cols]))
    counts, order = _decile_counts(df, score, label, [split], tie)
    both = counts.withColumn(split, F.explode(F.array(F.col(split), F.lit("all"))))
    merged = both.groupBy(split, *order).agg(F.sum("c").alias("c"))
    return _deciles(merged, order, label, [split], biz_cols, tie, 10)


def split_score_psi(
    df: DataFrame, score: str, split: str, base: str = "val", actual: str = "oot", n_bins: int = 10,
    digits: int | None = None,
) -> DataFrame:
    """PSI of the score between two splits, on the deciles of the base split."""
    sides = [df.where(F.col(split) == side).select(score) for side in (base, actual)]
    return feature_psi(sides[0], sides[1], [score], n_bins, digits)


def score_label_pairs(
    df: DataFrame, keep: Sequence[str], models: dict[str, str], labels: Sequence[str]
) -> DataFrame:
    """Long rows ``(keep…, model, label, score, y)`` for every model × label; incomplete pairs dropped."""
    cells = [
        F.struct(
            F.lit(name).alias("model"),
            F.lit(lab).alias("label"),
            null_if_nan(F.col(column).cast("double")).alias("score"),
            null_if_nan(F.col(lab).cast("double")).alias("y"),
        )
        for name, column in models.items()
        for lab in labels
    ]
    return df.select(*keep, F.inline(F.array(*cells))).where(
        F.col("score").isNotNull() & F.col("y").isNotNull()
    )


def multi_label_metrics(
    df: DataFrame, keys: Sequence[str], models: dict[str, str], labels: Sequence[str]
) -> DataFrame:
    """``(keys…, model, label, n, n_bad, auc, ks, gini)`` for every model × label with scored rows.

    All labels ride on one sort of the scores: each distinct score carries a bad and a good count per
    label, and a label that says nothing about a score leaves its running totals as they are.
    """
    cells = [
        F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias(_SCORE))
        for name, column in models.items()
    ]
    y = [F.col(lab).cast("double").alias(f"__y{i}") for i, lab in enumerate(labels)]
    long = df.select(*keys, *y, F.inline(F.array(*cells))).where(F.col(_SCORE).isNotNull() & ~F.isnan(_SCORE))
    counts = long.groupBy(*keys, "model", _SCORE).agg(
        *[F.count_if(F.col(f"__y{i}") > 0).alias(f"bad{i}") for i in range(len(labels))],
        *[F.count_if(F.col(f"__y{i}") <= 0).alias(f"good{i}") for i in range(len(labels))],
    )
    sums = [f"{side}{i}" for side in ("bad", "good") for i in range(len(labels))]
    group = [*keys, "model"]
    t = running_totals(counts, group, [_SCORE], sums)
    measures = []
    for i in range(len(labels)):
        measures += [
            f"max(total_bad{i}) AS b{i}",
            f"max(total_good{i}) AS g{i}",
            f"sum(CAST(bad{i} AS DOUBLE) * (before_good{i} + 0.5D * good{i})) AS p{i}",
            f"max(abs(try_divide(before_bad{i} + bad{i}, total_bad{i}) - "
            f"try_divide(before_good{i} + good{i}, total_good{i}))) AS k{i}",
        ]
    table = t.groupBy(*group).agg(*[F.expr(m) for m in measures])
    per_label = [
        F.struct(
            F.lit(lab).alias("label"),
            (F.col(f"b{i}") + F.col(f"g{i}")).alias("n"),
            F.col(f"b{i}").alias("n_bad"),
            F.try_divide(F.col(f"p{i}"), F.col(f"b{i}").cast("double") * F.col(f"g{i}")).alias("auc"),
            F.when((F.col(f"b{i}") > 0) & (F.col(f"g{i}") > 0), F.col(f"k{i}")).alias("ks"),
        )
        for i, lab in enumerate(labels)
    ]
    m = table.select(*group, F.inline(F.array(*per_label))).where(F.col("n") > 0)
    return m.withColumn("gini", F.abs(F.lit(2.0) * F.col("auc") - F.lit(1.0)))


def ks_grid(
    df: DataFrame, month: str, models: dict[str, str], labels: Sequence[str], min_cnt: int = 30
) -> DataFrame:
    """KS per month × label × model; null below ``min_cnt`` rows or with one class."""
    m = multi_label_metrics(df, [month], models, labels)
    return m.select(
        "model", "label", month, "n",
        F.when(F.col("n") >= min_cnt, F.round("ks", 4)).alias("ks"),
    )


def ks_delta(grid: DataFrame, month: str, first: str, second: str) -> DataFrame:
    """KS of the first model minus the second, per month × label."""
    of = {name: F.max(F.when(F.col("model") == name, F.col("ks"))) for name in (first, second)}
    return grid.groupBy(month, "label").agg(F.round(of[first] - of[second], 4).alias("delta"))


def ks_oot(
    df: DataFrame, month: str, models: dict[str, str], labels: Sequence[str], oot: tuple[str, str]
) -> DataFrame:
    """KS per model × label over all out-of-time months together."""
    m = multi_label_metrics(df.where(F.col(month).between(*oot)), [], models, labels)
    return m.select("model", "label", "n", F.round("ks", 4).alias("ks"))
