"""Name to (Spark query, SQL) registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f
    return register
