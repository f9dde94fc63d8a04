"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``sql`` is its oracle, if any."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(col) -> Column:
    """Doubles are compared at six decimals on both sides."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def joined(col) -> Column:
    """A set as text: sorted, '|' separated (stable across engines)."""
    return F.array_join(F.array_sort(F.col(col) if isinstance(col, str) else col), "|")
