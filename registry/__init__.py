"""Queries over the driver's tables, each with an independently written SQL form where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load() -> None:
    from registry import (  # noqa: F401
        q_cleaning, q_modelling, q_panel, q_profiling, q_quality, q_reporting, q_selection, q_sources,
    )
