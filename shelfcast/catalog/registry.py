"""Registered queries and, beside each, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .ctes import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, tables: str | None = None, body: str | None = None):
    """Register a query; ``body`` is its SQL over the named derived tables."""
    def add(fn):
        QUERIES[name] = fn
        if body is not None:
            SQL[name] = with_tables(tables, body) if tables else body
        return fn
    return add


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


def r(expression: str, places: int = 4) -> str:
    """SQL rounding whose zero has no sign."""
    return f"(CASE WHEN round({expression}, {places}) = 0 THEN CAST(0 AS DOUBLE) ELSE round({expression}, {places}) END)"
