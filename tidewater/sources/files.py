"""File sources and in-memory collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header line; every column is text."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; without a schema Spark reads the input twice to find one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, show_schema: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    if show_schema:
        df.printSchema()
    return df


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines; the codec of a compressed file follows from its suffix."""
    return spark.read.text(path)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row ``path, content`` per file, read in one piece by one task; Spark gives no row for an empty file."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def from_collection(spark: SparkSession, rows: list, schema: str | T.StructType, partitions: int) -> DataFrame:
    """A small driver-side collection in a given number of partitions."""
    return in_partitions(spark.createDataFrame(rows, schema), partitions)


def in_partitions(df: DataFrame, partitions: int) -> DataFrame:
    return df.repartition(partitions)
