"""Tables behind JDBC. Driver jar, address and credentials come from the caller, never from here."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater.functions.text import camel_columns


@dataclass(frozen=True)
class Split:
    """How to divide a table read: a numeric or date column, its rough bounds and the number of parallel reads."""

    column: str
    lower: str
    upper: str
    parts: int


def read_options(url: str, table: str, properties: dict[str, str], split: Split | None) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **properties}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.parts),
        }
    return options


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], split: Split | None = None, to_camel: bool = False
) -> DataFrame:
    """Typed rows of a table; without ``split`` one task reads it all, which suits configuration tables only."""
    df = spark.read.format("jdbc").options(**read_options(url, table, properties, split)).load()
    return camel_columns(df) if to_camel else df


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 1000) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_rows), **properties).mode("append").save()
