"""Missing values, numeric coercion, and the tests for text that must never leave a sample table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The two personal-data shapes that are rejected (18-character ID card, mobile number).
ID_CARD = r"\b\d{17}[\dxX]\b"
MOBILE = r"\b1[3-9]\d{9}\b"


def null_if_nan(col: Column) -> Column:
    """NaN becomes null; for columns that are doubles already."""
    return F.when(~F.isnan(col), col)


def to_number(col: Column) -> Column:
    """Numeric coercion: text that is not a number, and NaN, become null."""
    return null_if_nan(col.try_cast("double"))


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value to Spark's aggregates but a gap to every operator here: normalise at ingest."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


_PERSONAL = re.compile(f"{ID_CARD}|{MOBILE}")


def holds_personal_number(text: str | None) -> bool:
    return bool(_PERSONAL.search(text or ""))


def reject_personal_number(text: str | None) -> None:
    """For column names and filter texts, which end up in logs and reports."""
    if holds_personal_number(text):
        raise ValueError("text carries a personal identifier")


def label_family(name: Column) -> Column:
    """Display name of a label: ``fpd7_sx30`` → ``fpd7``; names of other families are unchanged."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(fpd7|fpd15|fpd30)", 1), F.lit("")), name)
