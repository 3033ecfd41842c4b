"""Registry of named queries ``(spark, sf_dir) -> DataFrame`` and their DuckDB
oracle SQL. Query modules register with :func:`query`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB oracle (omitted
    for ML and file-I/O operators, which get a rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that they register."""
    from opinari.plans import (  # noqa: F401
        q_absa,
        q_events,
        q_joins,
        q_ml,
        q_quality,
        q_sources,
        q_text,
    )
