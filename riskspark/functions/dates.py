"""Date expressions. Input may be a date, a timestamp, or text/int in one of two strict layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_date(col: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` text (or int) → date; anything else, e.g. ``2026-3-5``, → null."""
    text = F.trim(col.cast("string"))
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
        .when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
    )


def date_column(df: DataFrame, name: str) -> Column:
    """The column as a date; real dates and timestamps are only cast, so filters on them still push down."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_date(F.col(name))


def normalize_date(col: Column) -> Column:
    """Eight-digit text form, null when the input is not one of the two layouts."""
    return F.date_format(parse_date(col), "yyyyMMdd")


def is_date(col: Column) -> Column:
    return parse_date(col).isNotNull()


def month_prefix(col: Column) -> Column:
    """``YYYYMM``."""
    return F.date_format(parse_date(col), "yyyyMM")


def month_key(day: Column) -> Column:
    """``YYYY-MM`` of a date column."""
    return F.date_format(day, "yyyy-MM")


def iso_date(col: Column) -> Column:
    """``yyyy-MM-dd`` text form."""
    return F.date_format(parse_date(col), "yyyy-MM-dd")


def shift_days(col: Column, days: int) -> Column:
    """Date plus ``days`` (may be negative), in eight-digit form."""
    return F.date_format(F.date_add(parse_date(col), days), "yyyyMMdd")
