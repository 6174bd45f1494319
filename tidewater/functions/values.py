"""Typed values out of text maps, SQL-callable functions and a hand-made average."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_money(value: Column) -> Column:
    return value.try_cast("decimal(16,2)")


def product_text(count: Column, price: Column) -> Column:
    """Exact product of two money texts, as text with four decimals."""
    return (as_money(count) * as_money(price)).cast("string")


def keep_columns(data: Column, names: Column) -> Column:
    """Entries of a map whose key is in the comma list ``names``."""
    wanted = F.split(names, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(wanted, key))


def with_entry(data: Column, key: str, value: Column) -> Column:
    """Map with one entry set, whatever it held under that key."""
    others = F.map_filter(data, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), value.cast("string")))


def prefixed(text: Column, prefix: str = "name: ") -> Column:
    return F.concat(F.lit(prefix), text)


def register_prefix(spark: SparkSession, name: str = "prefix_name", prefix: str = "name: ") -> None:
    """The prefix function under a SQL name; Catalyst inlines its body."""
    literal = prefix.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) RETURNS STRING RETURN concat('{literal}', body)"
    )


def register_prefix_python(spark: SparkSession, name: str = "prefix_name_py", prefix: str = "addName: ") -> None:
    """The same surface for a function written in Python, in Arrow batches."""

    @F.pandas_udf("string")
    def apply(body):
        return prefix + body

    spark.udf.register(name, apply)


def average(value: Column) -> Column:
    """Mean as a (sum, count) pair merged on both sides of the shuffle, divided at the end."""
    return F.sum(value.cast("bigint")).cast("double") / F.count(value)
