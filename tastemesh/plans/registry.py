"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query may carry an oracle: DuckDB SQL over the same parquet tables,
written against the CTEs of :mod:`tastemesh.plans.oracle_views`.  Queries
without an oracle are the non-SQL-expressible ones (model fitting), checked
by property and round-trip tests instead.  Oracle texts are assembled only
when :func:`oracle_sql` is called, so importing the queries needs none of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` under ``name``; ``sql`` is its oracle body."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = (sql, views)
        return fn
    return deco


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of every query that has an oracle."""
    from tastemesh.plans.oracle_views import with_views
    return {name: with_views(list(views), sql) for name, (sql, views) in _SQL.items()}
