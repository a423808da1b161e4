"""Sentinel replacement and de-duplication.

De-duplication is an aggregation, not a window: partial minima run before the shuffle, so a key that holds
a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions.values import is_numeric
from riskspark.operators.validate import require_columns

# Placeholders that stand for "no data".
DEFAULT_SENTINELS = (-1.0, -2.0, -9.0, -99.0, -999.0, -9999.0, -99999.0)


def _numeric(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [c for c in features if c in df.columns and is_numeric(df.schema[c].dataType)]


def sentinel_replace(
    df: DataFrame, features: Sequence[str], values: Sequence[float] = DEFAULT_SENTINELS
) -> DataFrame:
    """Sentinels become null in the numeric features; ids, dates, labels and text are untouched."""
    numeric = set(_numeric(df, features))
    hits = [float(v) for v in values]
    return df.select(
        *[
            F.when(~F.col(c).cast("double").isin(hits), F.col(c)).alias(c) if c in numeric and hits else F.col(c)
            for c in df.columns
        ]
    )


def sentinel_report(
    df: DataFrame, features: Sequence[str], values: Sequence[float] = DEFAULT_SENTINELS
) -> DataFrame:
    """Features with hits: which values, how many rows, share of all rows."""
    numeric = _numeric(df, features)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(
        [], numeric, "feature", "value"
    )
    names = [str(int(v)) if float(v).is_integer() else str(v) for v in values]
    counted = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("value") == F.lit(float(v))).alias(f"h{i}") for i, v in enumerate(values)],
    )
    n_hit = sum((F.col(f"h{i}") for i in range(1, len(names))), F.col("h0"))
    hit_names = F.array_compact(
        F.array(*[F.when(F.col(f"h{i}") > 0, F.lit(name)) for i, name in enumerate(names)])
    )
    return counted.select(
        "feature",
        F.array_join(hit_names, ",").alias("hit_values"),
        n_hit.alias("n_hit"),
        F.round(n_hit / F.col("n"), 6).alias("hit_ratio"),
    ).where(F.col("n_hit") > 0)


def dedup_label_first(
    df: DataFrame, id_col: str, dt: str, label: str | None = None, order_cols: Sequence[str] = ()
) -> DataFrame:
    """One row per (id, date): a labelled row if there is one, else the first by ``order_cols``.

    Rows that agree on the order columns are told apart by their remaining columns, so the result does
    not depend on how the input is laid out. Null keys form groups of their own.
    """
    require_columns(df, [id_col, dt, label, *order_cols])
    keys = [id_col, dt]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    rank: list[Column] = [F.col(c) for c in order_cols if c not in keys] + [F.col(c) for c in rest]
    if label:
        rank.insert(0, F.col(label).isNull())
    payload = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*rank)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def dedup_first_nonnull(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: per column the first non-null value by ``order_cols``; null keys are dropped."""
    require_columns(df, [*keys, *order_cols])
    order = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]

    def first(c: str) -> Column:
        present = F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v")))
        return F.min(present).getField("v").alias(c)

    rows = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    grouped = rows.groupBy(*keys).agg(*[first(c) for c in df.columns if c not in keys])
    return grouped.select(*df.columns)


def dedup_report(df: DataFrame, id_col: str, dt: str) -> DataFrame:
    """Row counts before and after one-row-per-(id, date)."""
    groups = df.groupBy(id_col, dt).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n"), F.lit(0))
    after = F.count(F.lit(1))
    return groups.agg(
        before.alias("n_before"), after.alias("n_after"), (before - after).alias("n_removed")
    )
