"""Word splitting and name conversion."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = r"[\p{P}\p{S}\s]+"


def words(line: Column, sep: str = " ") -> Column:
    """Pieces of a line between single separators, trailing empty ones dropped as by a plain split.

    A line of separators only has no piece; an empty line is one empty piece.
    """
    cut = F.regexp_replace(line, f"({re.escape(sep)})+$", "")
    return F.when((cut == "") & (line != ""), F.array().cast("array<string>")).otherwise(F.split(cut, re.escape(sep)))


def tokens(text: Column) -> Column:
    """Words of a text without punctuation and symbols; NULL stays NULL."""
    return F.filter(F.split(text, SEPARATORS), lambda word: word != "")


def explode_tokens(
    df: DataFrame, text: Column, name: str = "keyword", tokenizer: Callable[[Column], Column] = tokens
) -> DataFrame:
    """One row per token of ``text``; a NULL text gives no row. ``tokenizer`` maps text to an array."""
    return df.withColumn(name, F.explode(tokenizer(text)))


def register_tokenizer(spark: SparkSession, name: str = "tokenization") -> None:
    """The tokenizer as a SQL table function, for ``JOIN LATERAL name(text)``; it runs without Python."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) RETURNS TABLE(keyword STRING) RETURN "
        "SELECT word FROM (SELECT explode(filter(split(body, r'"
        + SEPARATORS
        + "'), w -> w <> '')) AS word)"
    )


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", lambda m: "_" + m.group(1).lower(), name)


def camel(name: str) -> str:
    return re.sub(r"_([a-z0-9])", lambda m: m.group(1).upper(), name)


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(c) for c in df.columns])
