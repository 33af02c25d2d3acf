"""The named queries of the library and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function (spark, sf_dir) -> DataFrame, with its SQL where SQL can state it."""

    def add(made: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = made
        if sql is not None:
            ORACLE_SQL[name] = sql
        return made

    return add
