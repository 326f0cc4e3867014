"""Registered queries of the reference's operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "u1_top_hosts"


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query, and its SQL where SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add
