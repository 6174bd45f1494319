"""Registry of queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import ship_package, use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(queries: dict[str, Query], statements: dict[str, str], name: str, sql: str | None) -> Callable[[Query], Query]:
    """Register a query, which pins the zone and ships the package before it runs, and its checking statement."""

    def register(make: Query) -> Query:
        @wraps(make)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            use_utc(spark)
            ship_package(spark)
            return make(spark, sf)

        queries[name] = run
        if sql:
            statements[name] = sql.strip()
        return run

    return register


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the test tables and, where SQL can say the same, its checking statement."""
    return registered(QUERIES, SQL, name, sql)
