"""Queries of this subpackage by name, with checking SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.catalog.registry import registered

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    return registered(QUERIES, SQL, name, sql)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
