"""Row filters and column projections of a sample table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark.functions.dates import date_column
from riskspark.functions.values import reject_personal_number, to_number
from riskspark.operators.validate import require_columns
from riskspark.spec import SplitSpec, iso_day


def population_filter(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """AND of column = value; conditions on columns the table does not have are ignored."""
    for name, value in conditions.items():
        reject_personal_number(str(value))
        if name in df.columns:
            df = df.where(F.col(name) == F.lit(value))
    return df


def in_range(df: DataFrame, dt: str, start: str, end: str) -> Column:
    """Closed date range. On a real date or timestamp column the bounds push down to the scan."""
    first, last = F.lit(iso_day(start)).cast("date"), F.lit(iso_day(end)).cast("date")
    kind = df.schema[dt].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (F.col(dt) >= first.cast(kind)) & (F.col(dt) < F.date_add(last, 1).cast(kind))
    return date_column(df, dt).between(first, last)


def split_slice(df: DataFrame, dt: str, bounds: tuple[str, str]) -> DataFrame:
    """Rows inside a closed date range; dates that do not parse are outside."""
    require_columns(df, [dt])
    return df.where(in_range(df, dt, *bounds))


def split_tag(df: DataFrame, dt: str, splits: SplitSpec, name: str = "split") -> DataFrame:
    """Label each row with the first split whose range holds its date; rows in none are dropped."""
    tag = F.lit(None).cast("string")
    inside = F.lit(False)
    for split, (start, end) in reversed(list(splits.ranges.items())):
        hit = in_range(df, dt, start, end)
        tag, inside = F.when(hit, F.lit(split)).otherwise(tag), inside | hit
    return df.where(inside).withColumn(name, tag)


def fit_slice(df: DataFrame, dt: str, bounds: tuple[str, str]) -> DataFrame:
    """Rows used for a fit, compared as eight digits; an empty slice is an error."""
    require_columns(df, [dt])
    first, last = (iso_day(d).replace("-", "") for d in bounds)
    day = F.substring(F.regexp_replace(F.col(dt).cast("string"), "-", ""), 1, 8)
    rows = df.where(day.between(first, last))
    if rows.isEmpty():
        raise ValueError(f"no rows between {first} and {last}")
    return rows


def derive_features(columns: Sequence[str], excluded: Sequence[str | None]) -> list[str]:
    """All columns but the excluded ones, in order, once each."""
    drop = set(excluded)
    return [c for c in dict.fromkeys(columns) if c not in drop]


def match_features(available: Sequence[str], wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """Wanted features in the wanted order, split into present and missing."""
    have = set(available)
    unique = list(dict.fromkeys(wanted))
    return [c for c in unique if c in have], [c for c in unique if c not in have]


def interval_features(columns: Sequence[str], start: str, end: str, extra: Sequence[str] = ()) -> list[str]:
    """Columns from ``start`` to ``end`` by position, then any extra ones."""
    first, last = columns.index(start), columns.index(end)
    if first > last:
        raise ValueError(f"{start} comes after {end}")
    chosen = list(columns[first : last + 1])
    return chosen + [c for c in dict.fromkeys(extra) if c not in chosen]


def feature_projection(
    df: DataFrame, keep: Sequence[str], features: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Key columns and the listed features that exist; also the names that do not."""
    present, missing = match_features(df.columns, features)
    if not present:
        raise ValueError("none of the listed features is in the table")
    return df.select(*keep, *[c for c in present if c not in keep]), missing


def align_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model inputs as numbers in model order; every feature must exist."""
    require_columns(df, features)
    listed = set(features)
    return df.select(
        *[c for c in df.columns if c not in listed], *[to_number(F.col(c)).alias(c) for c in features]
    )


def score_passthrough(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Everything but the model's inputs: ids, dates, labels and scores."""
    return df.drop(*features)
