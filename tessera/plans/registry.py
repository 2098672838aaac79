"""Registry of the named queries run over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators; where the same result is expressible in ANSI SQL it
carries that SQL too (DuckDB runs it as the oracle).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle, if any."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so the registry is filled."""
    from tessera.plans import (  # noqa: F401
        relational_queries, reshape_queries, text_queries, json_queries,
        change_queries, history_queries, edit_queries, quality_queries,
        search_queries, sink_queries, stream_queries)
