"""Exact order statistics and running totals without a single-task sort.

A window ordered over a whole group would put that group in one task. Here the rows of all groups are
cut into at most a few thousand contiguous ranges of (group, order value), so that a hot group is spread
over many ranges; each range is sorted on its own and shifted by the subtotals of the ranges before it.

The range bounds are a min-hash sample of the distinct order values. They depend on the data alone, so
every branch of a plan (and every retried task) computes the same bounds; they only steer where rows are
sorted and never change a result. Their number is fixed, so the array that carries them stays small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

_KEY = "__key_hash"
_RANGE = "__range"
MAX_RANGES = 4096
PICK_RANGES = 256  # finer ranges leave fewer rows to sort when only a few ranks are wanted


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def range_count(df: DataFrame) -> int:
    """A power of two, twice the session's shuffle width, between 16 and ``MAX_RANGES``."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranges = 16
    while ranges < min(MAX_RANGES, 2 * width):
        ranges *= 2
    return ranges


def with_ranges(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], at_least: int = 16
) -> DataFrame:
    """Number each row's range. ``order`` columns are orderable and never null."""
    ranges = max(range_count(rows), at_least)
    rows = rows.withColumn(_KEY, F.xxhash64(*keys) if keys else F.lit(0).cast("bigint"))
    axes = [_KEY, *order]
    pick = F.xxhash64(*axes)
    sample = (
        rows.groupBy(F.pmod(pick, F.lit(ranges - 1)).alias("__slot"))
        .agg(*[F.min_by(c, pick).alias(f"__a{i}") for i, c in enumerate(axes)])
        .agg(F.sort_array(F.collect_list(F.struct(*[f"__a{i}" for i in range(len(axes))]))).alias("__s"))
        .select(F.struct(*[F.col(f"__s.__a{i}").alias(f"a{i}") for i in range(len(axes))]))
    )
    columns = rows.columns
    rows = rows.withColumn("__bounds", sample.scalar())
    # Binary search for the number of bounds below the row: one codegen'd projection per level, written
    # as lateral aliases of a single select (SQL text, as thousands of Column calls are slow to build).
    levels = ["0 AS __r0"]
    step = ranges // 2
    while step:
        low = f"__r{len(levels) - 1}"
        below = "false"
        for i, c in reversed(list(enumerate(axes))):
            bound = f"get(__bounds.a{i}, {low} + {step - 1})"
            below = f"({bound} < {quoted(c)} OR ({bound} = {quoted(c)} AND {below}))"
        levels.append(f"CASE WHEN {below} THEN {low} + {step} ELSE {low} END AS __r{len(levels)}")
        step //= 2
    found = rows.selectExpr(*[quoted(c) for c in columns], "__bounds", *levels)
    # The generated column is opaque to the optimizer: a predicate or join key on it would otherwise be
    # inlined through the levels above and grow exponentially.
    return found.select(*columns, F.explode(F.array(f"__r{len(levels) - 1}")).alias(_RANGE))


def _range_offsets(ranged: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per (group, range): what the earlier ranges of the group hold, and the group's total."""
    per_range = ranged.groupBy(_KEY, *keys, _RANGE).agg(*[F.sum(s).alias(s) for s in sums])
    group = W.partitionBy(_KEY, *keys)
    earlier = group.orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    return per_range.select(
        _KEY,
        *keys,
        _RANGE,
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"__off_{s}") for s in sums],
        *[F.sum(s).over(group).alias(f"total_{s}") for s in sums],
        *[F.col(s).alias(f"__in_{s}") for s in sums],
    )


def _shifted_totals(
    ranged: DataFrame,
    offsets: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    extra: Sequence[str] = (),
) -> DataFrame:
    """Join on the range and add the running total inside it; join and window share one shuffle."""
    rows, off = ranged.alias("r"), offsets.alias("o")
    same = (F.col(f"r.{_KEY}") == F.col(f"o.{_KEY}")) & (F.col(f"r.{_RANGE}") == F.col(f"o.{_RANGE}"))
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}"))
    carried = [f"__off_{s}" for s in sums] + [f"total_{s}" for s in sums] + list(extra)
    joined = rows.join(off, same).select("r.*", *[F.col(f"o.{c}") for c in carried])
    inside = (
        W.partitionBy(_KEY, _RANGE, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    )
    return joined.withColumns(
        {f"before_{s}": F.col(f"__off_{s}") + F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums}
    ).drop(_KEY, _RANGE, *[f"__off_{s}" for s in sums])


def running_totals(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Add ``before_<s>`` (sum over earlier rows of the group) and ``total_<s>`` for each summed column.

    ``rows`` holds one row per (keys, order): collapse ties with ``groupBy`` first, which is also what
    keeps a value shared by a third of the rows from being sorted a billion times.
    """
    ranged = with_ranges(rows, keys, order)
    return _shifted_totals(ranged, _range_offsets(ranged, keys, sums), keys, order, sums)


def pick_ranks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ranks: Column) -> DataFrame:
    """The rows at given 0-based ranks of each group: ``(keys…, n, at)``.

    ``ranks`` is an array over ``n`` (the group's size); ``at`` maps each rank inside the group to a struct
    of the ``order`` columns. Only ranges that hold a wanted rank are shuffled; the others are counted.
    """
    ranges = max(PICK_RANGES, range_count(rows))
    ranged = with_ranges(
        rows.select(*keys, *order).withColumn("__n", F.lit(1).cast("bigint")), keys, order, ranges
    )
    first, held = F.col("__off___n"), F.col("__in___n")
    offsets = (
        _range_offsets(ranged, keys, ["__n"])
        .withColumn("n", F.col("total___n"))
        .withColumn("__all", ranks)  # a column first: a rank may hold a subquery, a lambda must not
        .withColumn("__asked", F.filter("__all", lambda r: (r >= first) & (r < first + held)))
        .where(F.size("__asked") > 0)
        .drop("__all")
    )
    # One flag per range number: at most MAX_RANGES booleans.
    flags = offsets.agg(F.collect_set(_RANGE).alias("s")).select(
        F.transform(F.sequence(F.lit(0), F.lit(ranges)), lambda i: F.array_contains("s", i))
    )
    collapsed = (
        ranged.where(F.get(flags.scalar(), F.col(_RANGE)))
        .groupBy(_KEY, *keys, _RANGE, *order)
        .agg(F.sum("__n").alias("__n"))
    )
    placed = _shifted_totals(collapsed, offsets, keys, order, ["__n"], ["n", "__asked"])
    before, size = F.col("before___n"), F.col("__n")
    inside = F.filter("__asked", lambda r: (r >= before) & (r < before + size))
    # A group keeps one small map: an entry per asked rank.
    return (
        placed.select(*keys, "n", *order, F.explode(inside).alias("__rank"))
        .groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("__rank", F.struct(*order)))).alias("at"),
        )
    )


def rank_threshold(rows: DataFrame, keys: Sequence[str], order: Sequence[str], rank: Column) -> DataFrame:
    """The order values at one rank per group: ``(keys…, n, cut)``, null when the rank is outside."""
    picked = pick_ranks(rows, keys, order, F.array(rank.cast("bigint")))
    return picked.select(*keys, "n", F.try_element_at("at", rank.cast("bigint")).alias("cut"))


def ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "rank") -> DataFrame:
    """0-based position of every row within its group, for rows with distinct (keys, order)."""
    counted = rows.withColumn("__one", F.lit(1).cast("bigint"))
    return (
        running_totals(counted, keys, order, ["__one"])
        .withColumnRenamed("before___one", rank)
        .drop("__one", "total___one")
    )
