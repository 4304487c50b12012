"""The registry of queries: each has a name, a function of (spark, folder) and, where SQL can express it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE[key] = sql
        return f

    return register
