"""The traffic queries by operator id, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.session import ship

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) and, where SQL can express it, its SQL."""

    def put(function: Callable[[SparkSession, str], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"two queries are named {name}")
        _QUERIES[name] = lambda spark, sf_dir: function(ship(spark), sf_dir)
        if sql:
            _SQL[name] = sql
        return function

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from flowloom.plans import scalars, tables, traffic  # noqa: F401  they register

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
