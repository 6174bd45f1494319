"""Joins and sorts that stay balanced when one key holds a large share of the rows, and a filter that spares a join rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_join(
    left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner", extra: Column | None = None, null_safe: bool = False
) -> DataFrame:
    """Join where a key of ``left`` may be hot and an input may come out of a join or grouping on that key.

    ``keys`` maps left columns to right columns. Adaptive execution splits hot partitions only when both inputs
    are shuffles made for this join; an input that is already partitioned by the key would not be shuffled and
    so not be split. The hash in the condition asks for the shuffle. A side that Spark measures below the
    broadcast threshold is broadcast at run time instead. With ``null_safe`` NULL keys match each other.
    """
    lhs = left.withColumn("_left_hash", F.xxhash64(*keys.keys()))
    rhs = right.withColumn("_right_hash", F.xxhash64(*keys.values()))
    condition = F.col("_left_hash") == F.col("_right_hash")
    for a, b in keys.items():
        condition = condition & (F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b))
    if extra is not None:
        condition = condition & extra
    return lhs.join(rhs, condition, how).drop("_left_hash", "_right_hash")


#: Bits of the hash that the bitmap of ``likely_in`` uses, and words of 64 of them in one line of it: 2^27 bits are 16 MB.
MAP_BITS, LINE_BITS = 27, 8


def likely_in(rows: DataFrame, wanted: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The rows whose key is among ``wanted``, and a few others; for an inner join with ``wanted`` that is selective.

    ``keys`` maps columns to columns of ``wanted``, of one type each. A bitmap over their hash, of one size for any input,
    is computed once in a subquery. What tests it is a plain filter, so that Spark moves it below the joins and shuffles
    that ``rows`` come from. Where most bits are set it keeps most rows and is of no use, but drops none that is wanted.
    """

    def place(names):
        at = F.shiftrightunsigned(F.xxhash64(*names), 64 - MAP_BITS)
        word, bit = F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")
        return F.shiftright(word, LINE_BITS).cast("int"), word.bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int"), bit

    line, word, bit = place(keys.values())
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = wanted.groupBy(line.alias("line"), word.alias("word")).agg(F.bit_or(one).alias("bits"))
    sparse = words.groupBy("line").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    dense = F.transform(F.sequence(F.lit(0), F.lit((1 << LINE_BITS) - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("long")))
    lines = rows.sparkSession.range(1 << (MAP_BITS - 6 - LINE_BITS)).join(sparse, F.col("id") == F.col("line"), "left").select("id", dense.alias("words"))
    bitmap = lines.agg(F.array_sort(F.collect_list(F.struct("id", "words"))).alias("lines")).select("lines.words").scalar()
    line, word, bit = place(keys.keys())
    return rows.where(F.call_function("shiftrightunsigned", bitmap[line][word], bit).bitwiseAND(F.lit(1)) == 1)


def attach(facts: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """Left join with a summary of one row per ``key``, NULL being a key like others.

    The summary leaves its grouping partitioned by the key.
    """
    other = f"{key}__summary"
    return hot_join(facts, summary.withColumnRenamed(key, other), {key: other}, "left", null_safe=True).drop(other)


def mark(facts: DataFrame, chosen: DataFrame, identity: tuple[str, ...], flag: str) -> DataFrame:
    """Flag the rows of ``facts`` whose identity is in ``chosen``.

    The join key is the identity of the row, not its group, so the rows of a hot group spread over all tasks. NULL
    parts of an identity match each other.
    """
    hits = chosen.select(*[F.col(c).alias(f"{c}__chosen") for c in identity], F.lit(1).alias(flag))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}__chosen")) for c in identity])
    marked = facts.join(hits, same, "left").drop(*[f"{c}__chosen" for c in identity])
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def sorted_by(df: DataFrame, *order: Column, ties: tuple[str, ...] = ()) -> DataFrame:
    """Global sort; the tie columns let the range partitioner split rows of equal sort value."""
    return df.orderBy(*order, *[F.col(c) for c in ties])
