"""Tables of the business evaluation report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.functions.dates import date_column, month_key
from riskspark.operators.bins import attach_edges, bin_index, quantile_edges, unpivot_features
from riskspark.operators.clean import dedup_first_nonnull
from riskspark.operators.project import population_filter
from riskspark.operators.quality import multi_label_metrics, score_label_pairs
from riskspark.operators.stability import psi_term
from riskspark.sources.staging import stage

MIN_COUNT = 30
HEAD_TAIL_SHARE = 0.01  # fixed value: score bins thinner than this in every month are merged


def report_frame(
    df: DataFrame, id_col: str, dt: str, order_cols: Sequence[str], conditions: dict[str, object] | None = None
) -> DataFrame:
    """Filtered rows with a ``month`` column, one per (month, user)."""
    rows = population_filter(df, conditions or {}).withColumn("month", month_key(date_column(df, dt)))
    return dedup_first_nonnull(rows, ["month", id_col], order_cols)


def _rate(bad: Column, n: Column, min_cnt: int) -> Column:
    return F.when((n >= min_cnt) & (n > 0), bad / n)


def with_total(table: DataFrame, axis: str, others: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Append total rows (null on ``axis``) to an already small aggregate."""
    doubled = table.withColumn(axis, F.explode(F.array(F.col(axis), F.lit(None))))
    return doubled.groupBy(*others, axis).agg(*[F.sum(s).alias(s) for s in sums])


def month_stats(df: DataFrame, month: str, id_col: str, label: str, min_cnt: int = MIN_COUNT) -> DataFrame:
    """Per month: distinct users, labelled rows, bad rows, bad rate."""
    n, bad = F.count(label), F.count_if(F.col(label) > 0)
    return df.groupBy(month).agg(
        F.count_distinct(id_col).alias("users"), n.alias("performed"), bad.alias("bad"),
        _rate(bad, n, min_cnt).alias("bad_rate"),
    )


def label_grid(df: DataFrame, month: str, labels: Sequence[str], min_cnt: int = MIN_COUNT) -> DataFrame:
    """Per month × label: labelled rows, bad rows, bad rate."""
    long = df.select(month, *[F.col(c).cast("double").alias(c) for c in labels]).unpivot(
        [month], list(labels), "label", "y"
    )
    n, bad = F.count("y"), F.count_if(F.col("y") > 0)
    return long.groupBy(month, "label").agg(
        n.alias("performed"), bad.alias("bad"), _rate(bad, n, min_cnt).alias("bad_rate")
    )


def lift_table(
    df: DataFrame, models: dict[str, str], labels: Sequence[str], n_bins: int = 10,
    min_cnt: int = MIN_COUNT, digits: int | None = None,
) -> DataFrame:
    """Equal-frequency score bins per model × label, low score first; ``bin`` null is the total row."""
    pairs = score_label_pairs(df, [], models, labels)
    keys = ["model", "label"]
    edges = quantile_edges(pairs, keys, "score", n_bins, digits, min_rows=1, groups=len(models) * len(labels))
    placed = attach_edges(pairs, edges, keys, len(models) * len(labels), n_bins).withColumn(
        "bin", bin_index("score", "edges", n_bins)
    )
    counts = placed.where(F.col("bin").isNotNull()).groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("bad")
    )
    t = with_total(counts, "bin", keys, ["n", "bad"])
    group = W.partitionBy(*keys)
    total = F.max(F.when(F.col("bin").isNull(), F.col("bad") / F.col("n"))).over(group)
    rate = F.when(F.col("bin").isNull(), F.col("bad") / F.col("n")).otherwise(
        _rate(F.col("bad"), F.col("n"), min_cnt)
    )
    lift = F.when(F.col("bin").isNotNull() & (total > 0), F.round(rate / total, 4))
    return t.select(*keys, "bin", "n", "bad", rate.alias("bad_rate"), lift.alias("lift"))


def _swap_cells(df: DataFrame, old: str, new: str, label: str, n_bins: int, digits: int | None):
    rows = df.select(
        F.col(old).cast("double").alias("old"), F.col(new).cast("double").alias("new"), F.col(label).alias("y")
    ).dropna()
    edges = quantile_edges(
        unpivot_features(rows, [], ["old", "new"]), ["feature"], n_bins=n_bins, digits=digits, min_rows=1, groups=2
    )
    both = edges.agg(
        *[F.max(F.when(F.col("feature") == side, F.col("edges"))).alias(side) for side in ("old", "new")]
    )
    fitted = both.select(F.struct("old", "new")).scalar()  # two short arrays
    binned = rows.withColumn("__e", fitted).select(
        "old", "new", "y",
        bin_index("old", "__e.old", n_bins).alias("old_bin"),
        bin_index("new", "__e.new", n_bins).alias("new_bin"),
    )
    return binned, both


def swap_matrix(
    df: DataFrame, old: str, new: str, label: str, n_bins: int = 5, min_cnt: int = MIN_COUNT,
    digits: int | None = None,
) -> DataFrame:
    """Old-score bins × new-score bins: rows, bad rows, bad rate, with null bins as totals."""
    binned, both = _swap_cells(df, old, new, label, n_bins, digits)
    counts = binned.groupBy("old_bin", "new_bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("bad")
    )
    # Empty cells count as zero: the grid comes from the number of bins on each side.
    grid = both.select(
        F.explode(F.sequence(F.lit(1), F.size("old") - 1)).alias("old_bin"), "new"
    ).select("old_bin", F.explode(F.sequence(F.lit(1), F.size("new") - 1)).alias("new_bin"))
    full = grid.join(counts, ["old_bin", "new_bin"], "left").na.fill(0, ["n", "bad"])
    t = with_total(
        with_total(full, "new_bin", ["old_bin"], ["n", "bad"]), "old_bin", ["new_bin"], ["n", "bad"]
    )
    return t.select(
        "old_bin", "new_bin", "n", "bad", _rate(F.col("bad"), F.col("n"), min_cnt).alias("bad_rate")
    )


def swap_bin_ranges(
    df: DataFrame, old: str, new: str, label: str, n_bins: int = 5, digits: int | None = None
) -> DataFrame:
    """Lowest and highest score inside each swap bin, for display."""
    binned, _ = _swap_cells(df, old, new, label, n_bins, digits)
    sides = binned.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("side"), F.col(f"{s}_bin").alias("bin"), F.col(s).alias("score"))
                    for s in ("old", "new")
                ]
            )
        )
    )
    return sides.groupBy("side", "bin").agg(F.min("score").alias("low"), F.max("score").alias("high"))


# Score bins. The raw grid is 0.1 steps on [0, 1] for probabilities and 10-point steps otherwise; an index
# is guessed by division and corrected against the exact edge, because division alone is off on edges.

def _grid_struct(df: DataFrame, score: str) -> Column:
    s = F.col(score).cast("double")
    low, high = F.min(s), F.max(s)
    unit = (low >= 0) & (high <= 1)
    floor10, ceil10 = F.floor(low / 10) * 10, F.ceil(high / 10) * 10
    cells = F.greatest(F.lit(1), (ceil10 - floor10) / 10)
    return df.agg(
        F.struct(
            F.coalesce(unit, F.lit(True)).alias("unit"),
            F.when(unit, F.lit(0)).otherwise(floor10).cast("double").alias("low"),
            F.when(unit, F.lit(10)).otherwise(cells).cast("bigint").alias("cells"),
        ).alias("g")
    ).scalar()


def _edge(grid: Column, k: Column) -> Column:
    return F.when(grid["unit"], k.cast("double") / F.lit(10.0)).otherwise(grid["low"] + k.cast("double") * 10)


def _indexed(df: DataFrame, score: str, keep: Sequence[str]) -> DataFrame:
    """Raw cell of each score, left-closed (``left``) and right-closed (``right``)."""
    s, g = F.col("s"), F.col("g")
    guess = F.floor(F.when(g["unit"], s * 10).otherwise((s - g["low"]) / 10))
    fixed = (
        F.when(s < _edge(g, F.col("k")), F.col("k") - 1)
        .when(s >= _edge(g, F.col("k") + 1), F.col("k") + 1)
        .otherwise(F.col("k"))
    )

    def clamp(k: Column) -> Column:
        # greatest/least skip nulls, and a row without a score must stay without a cell
        return F.when(s.isNotNull(), F.greatest(F.lit(0), F.least(g["cells"] - 1, k)))

    return (
        df.select(*keep, F.col(score).cast("double").alias("s"), _grid_struct(df, score).alias("g"))
        .withColumn("k", guess)
        .withColumn("left", clamp(fixed))
        .withColumn("right", F.when(s <= _edge(g, F.col("left")), clamp(F.col("left") - 1)).otherwise(F.col("left")))
    )


def score_cells(df: DataFrame, month: str, score: str) -> DataFrame:
    """``(month, left, g, n)``: rows per raw cell; scoreless rows keep their month with a null cell.

    Bins, distribution, PSI and segments of one score all start from this table of months × cells, so it is
    written once; pass it on as ``cells`` to spare its two passes over the rows.
    """
    return stage(_indexed(df, score, [month]).groupBy(month, "left", "g").agg(F.count("s").alias("n")))


def _kept_cells(cells: DataFrame, month: str) -> Column:
    """First and last raw cell whose share reaches the limit in some month."""
    share = F.try_divide(F.col("n"), F.sum("n").over(W.partitionBy(month)))
    solid = cells.where(F.col("left").isNotNull()).withColumn("ok", share >= HEAD_TAIL_SHARE)
    head, tail = F.min(F.when(F.col("ok"), F.col("left"))), F.max(F.when(F.col("ok"), F.col("left")))
    last = F.coalesce(F.max("g")["cells"], F.lit(10)) - 1
    return solid.agg(
        F.struct(
            F.coalesce(head, F.lit(0)).alias("head"), F.coalesce(tail, last).alias("tail"),
            F.coalesce(F.max("g")["unit"], F.lit(True)).alias("unit"),
            F.coalesce(F.max("g")["low"], F.lit(0.0)).alias("low"),
            (last + 1).alias("cells"),
        ).alias("k")
    ).scalar()


def _trim(cell: Column, kept: Column) -> Column:
    inside = F.greatest(kept["head"], F.least(kept["tail"], cell)) - kept["head"] + 1
    return F.when(cell.isNotNull(), inside).cast("int")


def _with_kept(table: DataFrame, cells: DataFrame, month: str) -> DataFrame:
    return table.withColumn("__k", _kept_cells(cells, month))


def score_bins(df: DataFrame, month: str, score: str, cells: DataFrame | None = None) -> DataFrame:
    """The trimmed bins: number, bounds, and a text label."""
    kept = _kept_cells(cells or score_cells(df, month, score), month)
    one = df.sparkSession.range(1).select(kept.alias("k"))
    k = F.col("k")
    rows = one.select("k", F.explode(F.sequence(F.lit(1), k["tail"] - k["head"] + 1)).alias("bin"))
    low = F.when(F.col("bin") == 1, F.lit(0)).otherwise(k["head"] + F.col("bin") - 1)
    high = F.when(F.col("bin") == k["tail"] - k["head"] + 1, k["cells"]).otherwise(k["head"] + F.col("bin"))

    def text(x: Column) -> Column:
        return F.when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))

    lo, hi = _edge(k, low), _edge(k, high)
    return rows.select(
        F.col("bin").cast("int").alias("bin"), lo.alias("low"), hi.alias("high"),
        F.concat(text(lo), F.lit("-"), text(hi)).alias("bin_label"),
    )


def _month_bin_grid(counts: DataFrame, month: str) -> DataFrame:
    k = F.col("__k")
    months = counts.select(month, "__k").dropDuplicates([month])
    return months.select(
        month, F.explode(F.sequence(F.lit(1), (k["tail"] - k["head"] + 1).cast("int"))).alias("bin")
    )


def _distribution(counts: DataFrame, month: str) -> DataFrame:
    """Zero-filled ``(month, bin, n)`` on left-closed bins, the last one closed on both sides."""
    cells = _with_kept(counts, counts, month)
    counts = cells.groupBy(month, _trim(F.col("left"), F.col("__k")).alias("bin")).agg(F.sum("n").alias("n"))
    return _month_bin_grid(cells, month).join(counts, [month, "bin"], "left").na.fill(0, ["n"])


def score_distribution(df: DataFrame, month: str, score: str, cells: DataFrame | None = None) -> DataFrame:
    """Rows and share per month × score bin; ``bin`` null is the month's total."""
    t = with_total(_distribution(cells or score_cells(df, month, score), month), "bin", [month], ["n"])
    total = F.max(F.when(F.col("bin").isNull(), F.col("n"))).over(W.partitionBy(month))
    return t.select(month, "bin", "n", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)).alias("share"))


def score_psi(
    df: DataFrame, month: str, score: str, base_month: str, cells: DataFrame | None = None
) -> DataFrame:
    """PSI of the score bins per month against the base month, 4 digits; null without scores or base month."""
    d = _distribution(cells or score_cells(df, month, score), month)
    share = F.try_divide(F.col("n"), F.sum("n").over(W.partitionBy(month)))
    d = d.withColumn("a", share)
    base = F.max(F.when(F.col(month) == base_month, F.coalesce("a", F.lit(0.0)))).over(W.partitionBy("bin"))
    term = psi_term(F.col("a"), F.coalesce(F.col("b"), F.lit(0.0)))
    return d.withColumn("b", base).groupBy(month).agg(
        F.when(F.count("b") > 0, F.round(F.sum(term), 4)).alias("psi")
    )


def segment_bad_rate(
    df: DataFrame, month: str, score: str, labels: Sequence[str], min_cnt: int = MIN_COUNT,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Per label × month × score bin (right-closed): rows, bad rows, bad rate; ``bin`` null is the total."""
    idx = _indexed(df, score, [month, *labels]).where(F.col("s").isNotNull())
    long = idx.select(
        month, "right",
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("y")) for c in labels]
            )
        ),
    )
    raw = long.groupBy("label", month, "right").agg(
        F.count("y").alias("n"), F.count_if(F.col("y") > 0).alias("bad")
    )
    binned = _with_kept(raw, cells or score_cells(df, month, score), month)
    counts = binned.groupBy("label", month, _trim(F.col("right"), F.col("__k")).alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    k = F.col("__k")
    grid = binned.select("label", month, "__k").dropDuplicates(["label", month]).select(
        "label", month, F.explode(F.sequence(F.lit(1), (k["tail"] - k["head"] + 1).cast("int"))).alias("bin")
    )
    full = grid.join(counts, ["label", month, "bin"], "left").na.fill(0, ["n", "bad"])
    t = with_total(full, "bin", ["label", month], ["n", "bad"])
    return t.select("label", month, "bin", "n", "bad", _rate(F.col("bad"), F.col("n"), min_cnt).alias("bad_rate"))


def report_checks(
    df: DataFrame, month: str, models: dict[str, str], labels: Sequence[str],
    oot: tuple[str, str], base_month: str,
) -> DataFrame:
    """Findings that make a report untrustworthy: ``(check, model, label, value, failed)``."""
    none = F.lit(None).cast("string")

    def row(check: str, model: Column, label: Column, value: Column, failed: Column) -> list[Column]:
        return [
            F.lit(check).alias("check"), model.alias("model"), label.alias("label"),
            value.cast("double").alias("value"), F.coalesce(failed, F.lit(False)).alias("failed"),
        ]

    both = F.lit(True)
    for column in models.values():
        both = both & F.col(column).isNotNull()
    in_oot = F.col(month).between(*oot)
    # Everything countable in one pass.
    wide = df.agg(
        *[F.count(c).alias(f"s_{m}") for m, c in models.items()],
        *[F.count_if(F.col(lab) > 0).alias(f"p_{lab}") for lab in labels],
        *[F.count_if(in_oot & both & F.col(lab).isNotNull()).alias(f"b_{lab}") for lab in labels],
    )
    counted = wide.select(
        F.inline(
            F.array(
                *[F.struct(*row("score_rows", F.lit(m), none, F.col(f"s_{m}"), F.col(f"s_{m}") == 0)) for m in models],
                *[F.struct(*row("label_positives", none, F.lit(x), F.col(f"p_{x}"), F.col(f"p_{x}") == 0)) for x in labels],
                *[F.struct(*row("rows_with_all_scores", none, F.lit(x), F.col(f"b_{x}"), F.lit(False))) for x in labels],
            )
        )
    )
    ks = multi_label_metrics(df.where(in_oot), [], models, labels).where(F.col("n_bad") > 0)
    k = F.coalesce("ks", F.lit(0.0))
    checks = counted.unionByName(
        ks.select(*row("oot_ks", F.col("model"), F.col("label"), k, ~((k > 0) & (k < 1))))
    )
    for m, c in models.items():
        cells = score_cells(df, month, c)
        bins = score_bins(df, month, c, cells).agg(F.count(F.lit(1)).alias("v"))
        checks = checks.unionByName(bins.select(*row("score_bins", F.lit(m), none, F.col("v"), F.col("v") <= 1)))
        psi = score_psi(df, month, c, base_month, cells).agg(F.max("psi").alias("v"), F.count("psi").alias("n"))
        flat = (F.col("n") >= 2) & (F.abs("v") < 1e-9)
        checks = checks.unionByName(psi.select(*row("max_month_psi", F.lit(m), none, F.col("v"), flat)))
    return checks
