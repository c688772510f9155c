"""Where queries register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def with_sql(views: str, rest: str) -> str:
    return f"with {views}{rest}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: f(utc(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return f

    return add
