"""Registry of named queries (Spark side) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .view_sql import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is the oracle body
    (views from FIXTURES.md are added as CTEs). ``sql=None``: rows-only check."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers on import)."""
    from . import (catalog_queries, event_queries, ingest_queries, region_queries,  # noqa: F401
                   series_queries, spectral_queries)
