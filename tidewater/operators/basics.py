"""Row-wise, grouping and sorting operators on plain collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import words
from tidewater.operators.skew import attach, sorted_by


def sql_filter(df: DataFrame, view: str, condition: str) -> DataFrame:
    """``SELECT *`` with a condition, through a temporary view."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT * FROM {view} WHERE {condition}")


def doubled(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column) * 2)


def flat_map_words(df: DataFrame, line: str = "value", alias: str = "word") -> DataFrame:
    return df.select(F.explode(words(F.col(line))).alias(alias))


def odd(df: DataFrame, column: str) -> DataFrame:
    """Rows with remainder 1; a negative odd number has remainder -1 and fails."""
    return df.where(F.col(column) % 2 == 1)


def to_pairs(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.alias("k"), value.alias("v"))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, by name, with its types; a text that does not fit its type gives NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def flow_record(df: DataFrame, up: str = "up", down: str = "down") -> DataFrame:
    """Flow with its sum, and the record as tab text."""
    total = df.withColumn("sum", F.col(up) + F.col(down))
    return total.withColumn("line", F.concat_ws("\t", up, down, "sum"))


def group_values(df: DataFrame, key: Column, value: Column, row_id: Column, page_rows: int = 10_000) -> DataFrame:
    """Values of each group, in pages of about ``page_rows`` values.

    A group may hold any share of the rows, so it does not become one array. A group has as many pages as its own
    count asks for, one if it is small; a hash of the unique ``row_id`` deals its rows to them. The pages of a key
    together hold every value.
    """
    rows = df.select(key.alias("k"), value.alias("v"), row_id.cast("string").alias("id"))
    pages = rows.groupBy("k").agg(F.ceil(F.count("*") / page_rows).alias("pages"))
    number = F.conv(F.substring(F.md5("id"), 1, 8), 16, 10).cast("bigint") % F.col("pages")
    paged = attach(rows, pages, "k").select("k", F.when(F.col("pages") > 1, number).otherwise(0).alias("page"), "v")
    return paged.groupBy("k", "page").agg(F.sort_array(F.collect_list("v")).alias("items"))


def reduce_sum(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("k").agg(F.sum("v").alias("v"))


def count_by_key(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("k").agg(F.count("*").alias("n"))


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_sorted(df: DataFrame) -> DataFrame:
    """Each line once, sorted."""
    return df.distinct().orderBy(*df.columns)


def sort_desc(df: DataFrame, column: str, ties: tuple[str, ...] = ()) -> DataFrame:
    return sorted_by(df, -F.col(column), ties=ties)


def sort_last_char(df: DataFrame, column: str, ties: tuple[str, ...] = ()) -> DataFrame:
    return sorted_by(df, F.substring(column, -1, 1), ties=(column, *ties))


def sort_by_key(pairs: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Pairs by key, then value, then ``ties``: name the identity of a row there when pairs repeat often."""
    return sorted_by(pairs, F.col("k"), ties=("v", *ties))


def take(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a fixed order; each task keeps only its best ``n``."""
    return df.orderBy(*order).limit(n)
