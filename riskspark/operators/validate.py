"""Input checks: required columns, label and date domains, personal data in text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from riskspark.functions.dates import date_column
from riskspark.functions.values import ID_CARD, MOBILE


def require_columns(df: DataFrame, columns: Iterable[str | None]) -> None:
    missing = [c for c in columns if c and c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")


def label_violations(df: DataFrame, label: str) -> DataFrame:
    """Distinct non-null label values other than 0 and 1."""
    require_columns(df, [label])
    return df.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).select(label).distinct()


def date_violations(df: DataFrame, dt: str) -> DataFrame:
    """Distinct non-null values of ``dt`` that are in neither date layout."""
    require_columns(df, [dt])
    return df.where(F.col(dt).isNotNull() & date_column(df, dt).isNull()).select(dt).distinct()


def sensitive_scan(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per text column: rows, and rows that carry an ID-card or a mobile number. One scan."""
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).rlike(ID_CARD)).alias(f"i{i}") for i, c in enumerate(names)],
        *[F.count_if(F.col(c).rlike(MOBILE)).alias(f"m{i}") for i, c in enumerate(names)],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col("n_rows"),
                        F.col(f"i{i}").alias("n_id_card"),
                        F.col(f"m{i}").alias("n_mobile"),
                    )
                    for i, c in enumerate(names)
                ]
            )
        )
    )
