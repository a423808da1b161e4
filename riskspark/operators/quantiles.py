"""Exact quantiles of many groups in two passes over the rows.

1. A mergeable sketch per group brackets every wanted rank: two values between which the rank must lie if the sketch keeps
   its promise of ``1 / ACCURACY`` of the group's rows. Brackets belong to a group, so a group gets as many as it has ranks
   wanted, whatever the number of other groups.
2. One pass counts exactly. Rows inside a bracket are collapsed to distinct values; rows between two brackets become one
   counter, with their least and greatest value, before anything is shuffled. A group of any size thus sends a few
   thousandths of its rows, dealt by bracket, and one row a task and gap.

Offsets of the brackets and positions inside them are summed from those counts. The sketch steers only what is kept; if a
rank falls into a gap after all, the groups concerned are selected by counted ranges instead (``ranks.pick_ranks``).

Several conditions on the rows ("purposes") share both passes, each with quantiles of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.operators.ranks import pick_ranks, quoted, running_totals
from riskspark.sources.staging import stage

ACCURACY = 2000
# Brackets are broadcast up to this many numbers (16 MB); beyond, they are joined by shuffle.
BROADCAST_NUMBERS = 2_000_000
# Distinct values of one bracket that one task sorts; beyond, brackets are sorted in ranges.
BRACKET_ROWS = 4_000_000


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _sketches(
    rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], purposes: Mapping[str, Column]
) -> DataFrame:
    """(keys…, lo<i>, hi<i> per purpose): arrays with the ends of each probability's bracket."""
    slack = 1.25 / ACCURACY
    asked = [max(0.0, p - slack) for p in probabilities] + [min(1.0, p + slack) for p in probabilities]
    found = []
    for i, condition in enumerate(purposes.values()):
        v = F.when(condition, F.col(value))
        found += [F.percentile_approx(v, asked, ACCURACY).alias(f"s{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
    table = rows.groupBy(*keys).agg(*found)
    m, ends = len(probabilities), []
    for i in range(len(purposes)):
        for side, offset in (("lo", 0), ("hi", m)):
            at = []
            for k, p in enumerate(probabilities):
                outer = (f"min{i}" if p == 0 else f"max{i}") if p in (0, 1) else None
                at.append(F.col(outer) if outer else F.get(f"s{i}", F.lit(offset + k)))
            ends.append(F.array(*at).alias(f"{side}{i}"))
    return table.select(*[F.col(k).alias(f"__{k}") for k in keys], *ends)


def _cells(
    rows: DataFrame, keys: Sequence[str], value: str, m: int, purposes: Mapping[str, Column], brackets: DataFrame
) -> DataFrame:
    """(keys…, purpose, seg, cell, c, lo, hi): odd segments are brackets with a row per distinct value, even ones gaps."""
    v, parts = quoted(value), []
    for i, (name, condition) in enumerate(purposes.items()):
        j = " + ".join(f"CASE WHEN get(hi{i}, {k}) < {v} THEN 1 ELSE 0 END" for k in range(m))
        parts.append(F.when(condition, F.struct(F.lit(name).alias("purpose"), F.expr(j).alias("j"), F.col(f"lo{i}").alias("ends"))))
    placed = rows.join(brackets, _same(keys, [f"__{k}" for k in keys])).select(
        *keys, F.col(value).alias("v"), F.explode(F.array_compact(F.array(*parts))).alias("p")
    )
    inside = F.coalesce(F.col("v") >= F.get("p.ends", F.col("p.j")), F.lit(False))
    segments = placed.select(
        *keys, "p.purpose", (F.col("p.j") * 2 + inside.cast("int")).alias("seg"), F.when(inside, F.col("v")).alias("cell"), "v"
    )
    return segments.groupBy(*keys, "purpose", "seg", "cell").agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )


def quantiles_by_purpose(
    rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], purposes: Mapping[str, Column],
    groups: int | None = None,
) -> DataFrame:
    """``(keys…, purpose, n, q)``: linearly interpolated quantiles of the non-null values that meet each purpose's condition.

    ``groups`` is a proven bound on the number of key groups; without one the sketches are written and counted first.
    ``probabilities`` rise. Groups without a value have no row. The cells are written when the function is called.
    """
    keys = list(keys)
    asked = [float(p) for p in probabilities]
    present = rows.where(F.col(value).isNotNull())
    brackets = _sketches(present, keys, value, asked, purposes)
    if groups is None:
        brackets = stage(brackets)
        groups = brackets.count()
    if groups * 2 * len(asked) * len(purposes) <= BROADCAST_NUMBERS:
        brackets = F.broadcast(brackets)
    cells = stage(_cells(present, keys, value, len(asked), purposes, brackets))

    group = [*keys, "purpose"]
    over = W.partitionBy(*group)  # a few rows per bracket
    ps = "array(" + ", ".join(f"{p!r}D" for p in asked) + ")"
    at = "(p * CAST(n - 1 AS DOUBLE))"
    segments = cells.groupBy(*group, "seg").agg(
        F.sum("c").alias("held"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("values")
    ).withColumns(
        {
            "first": F.coalesce(F.sum("held").over(over.orderBy("seg").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "n": F.sum("held").over(over),
        }
    ).withColumn("ranks", F.expr(f"array_distinct(flatten(transform({ps}, p -> array(floor{at}, ceil{at}))))"))
    segments = segments.withColumn("ranks", F.expr("filter(ranks, r -> r >= first AND r < first + held)")).where(F.size("ranks") > 0)
    segments = stage(segments.select(*group, "seg", "held", "lo", "hi", "first", "n", "ranks", "values"))

    gap = F.col("seg") % 2 == 0
    edge = segments.where(gap).select(*group, "n", "lo", "hi", "first", "held", F.explode("ranks").alias("rank"))
    edge = edge.withColumn("v", F.when(F.col("rank") == F.col("first"), F.col("lo")).when(F.col("rank") == F.col("first") + F.col("held") - 1, F.col("hi")))
    wanted = segments.where(~gap).select(*[F.col(k).alias(f"__{k}") for k in [*group, "seg"]], "first", "n", "ranks")
    held = cells.where(gap == F.lit(False)).select(*group, "seg", "cell", "c")
    most = segments.where(~gap).agg(F.max("values")).first()[0] or 0
    if most <= BRACKET_ROWS:
        line = W.partitionBy(*group, "seg").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        counted = held.withColumn("before_c", F.coalesce(F.sum("c").over(line), F.lit(0)))
    else:
        counted = running_totals(held, [*group, "seg"], ["cell"], ["c"])
    low = F.col("first") + F.col("before_c")
    inner = counted.join(wanted, _same([*group, "seg"], [f"__{k}" for k in [*group, "seg"]])).select(
        *group, "n", F.col("cell").alias("v"), F.explode(F.filter("ranks", lambda r: (r >= low) & (r < low + F.col("c")))).alias("rank")
    )
    answers = inner.unionByName(edge.select(*group, "n", "v", "rank"))
    picked = answers.groupBy(*group).agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"), F.count_if(F.col("v").isNull()).alias("missed")
    )
    missed = edge.where(F.col("v").isNull())
    if not missed.isEmpty():
        picked = picked.where(F.col("missed") == 0).unionByName(
            _by_ranges(present, keys, value, purposes, missed, ps, at), allowMissingColumns=True
        )
    lo, hi = f"at[floor{at}]", f"at[ceil{at}]"
    t = f"({at} - floor{at})"
    # The two-sided form keeps the result exact at both ends.
    lerp = f"CASE WHEN {t} < 0.5D THEN {lo} + ({hi} - {lo}) * {t} ELSE {hi} - ({hi} - {lo}) * (1D - {t}) END"
    return picked.selectExpr(*[quoted(k) for k in group], "n", f"transform({ps}, p -> {lerp}) AS q")


def _by_ranges(
    present: DataFrame, keys: list[str], value: str, purposes: Mapping[str, Column], missed: DataFrame, ps: str, at: str
) -> DataFrame:
    """The groups whose sketch missed a rank, by counted ranges."""
    names = [F.when(condition, F.lit(name)) for name, condition in purposes.items()]
    long = present.select(*keys, F.col(value).alias("v"), F.explode(F.array_compact(F.array(*names))).alias("purpose"))
    open_ = missed.select(*[F.col(k).alias(f"__{k}") for k in [*keys, "purpose"]]).distinct()
    long = long.join(open_, _same([*keys, "purpose"], [f"__{k}" for k in [*keys, "purpose"]]), "left_semi")
    ranks = F.expr(f"array_distinct(flatten(transform({ps}, p -> array(floor{at}, ceil{at}))))")
    found = pick_ranks(long, [*keys, "purpose"], ["v"], ranks)
    return found.select(*keys, "purpose", "n", F.transform_values("at", lambda _, s: s["v"]).alias("at"))


def exact_quantiles(
    rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], groups: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles of the non-null values: ``n`` and an array ``q`` per group."""
    if not keys:
        rows, keys, groups = rows.withColumn("__all", F.lit(0)), ["__all"], 1
    return quantiles_by_purpose(rows, keys, value, probabilities, {"all": F.lit(True)}, groups).drop("purpose", "__all")
