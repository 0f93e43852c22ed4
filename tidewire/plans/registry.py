"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB oracle SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` (and its oracle SQL, if any)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


def all_queries() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from tidewire.plans import batch_queries, io_queries, ledger_queries, pane_queries, stream_queries  # noqa: F401
    return dict(QUERIES)


def all_oracle_sql() -> dict[str, str]:
    all_queries()
    return dict(ORACLE_SQL)
