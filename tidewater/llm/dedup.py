"""Exact dedup by an extendible-hash index on shared files.

A text is normalised and hashed to 64 bits. The index holds one entry per hash value, whatever the number of copies. A
bucket is a prefix of the hash bits; a bucket with more entries than its capacity is split by one more bit, which
doubles the directory where that is needed. Every bucket is a contiguous key range: the index lies on the shared folder
sorted by it, and the directory, a short table, tells each row the bucket that owns its hash value. Rows go to the owner
of their bucket and find their entry there. Entries that meet in one hash value are chained: bytes are compared, and
each different text becomes an entry of its own.

Bytes are compared only where a hash value has several rows. A bitmap of fixed size over the hash values, the same for
any input, tells which texts may be such: only they are shuffled, once, and only one copy of a text from each task.

All steps are DataFrame functions. A hot text meets a partial aggregation before every shuffle of its key, and the
joins split hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, staged, text_of
from tidewater.operators.skew import hot_join
from tidewater.session import new_dir

#: Bits of the hash that the directory may use at most: 2^DEPTH cells bound its size. A bucket at that depth keeps all
#: its entries, however many there are.
DEPTH = 16

#: Bits of the hash that the bitmap of shared hash values uses: 2^20 words of 64 bits at most are broadcast.
MAP_BITS = 26


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{BLANKS}]+", "")


def _best(chars: str, id_col: str) -> Column:
    """One number that is largest for the row to keep: most code points, then the smallest id; a null id comes last."""
    largest = F.lit("9223372036854775808").cast("decimal(38,0)")
    order = F.coalesce(largest - F.col(id_col).cast("decimal(20,0)"), F.lit(0).cast("decimal(38,0)"))
    return (F.col(chars).cast("decimal(12,0)") * F.lit("100000000000000000000").cast("decimal(21,0)") + order).cast("decimal(38,0)")


def directory(entries: DataFrame, capacity: int) -> DataFrame:
    """Local depth of each cell of the full directory: the smallest depth whose bucket fits, else ``DEPTH``.

    Splitting is done for all depths at once: a cell counts towards its prefix of every length. The table has at most
    2^DEPTH rows.
    """
    cell = F.shiftrightunsigned("key", 64 - DEPTH)
    cells = entries.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))))
    prefix = F.expr(f"shiftright(cell, {DEPTH} - depth)")
    sized = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("held"), F.collect_list("cell").alias("in_bucket"))
    fits = (F.col("held") <= capacity) | (F.col("depth") == DEPTH)
    return sized.filter(fits).select("depth", F.explode("in_bucket").alias("cell")).groupBy("cell").agg(F.min("depth").alias("depth"))


def owned(rows: DataFrame, depths: DataFrame) -> DataFrame:
    """Rows with the ``bucket`` that the directory gives their key; it has at most 2^DEPTH rows and is broadcast."""
    cells = F.broadcast(depths.select(F.col("cell").alias("owner_cell"), F.expr(f"shiftleft(shiftright(cell, {DEPTH} - depth), {DEPTH} - depth)").alias("bucket")))
    return rows.join(cells, F.shiftrightunsigned("key", 64 - DEPTH) == F.col("owner_cell")).drop("owner_cell")


def build_index(keys: DataFrame, path: str, capacity: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Write the index, one entry per hash value with its count and best row, in ranges of its buckets; and the directory."""
    spark = keys.sparkSession
    entries = staged(
        spark,
        keys.withColumn("best", _best("chars", "id"))
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.max("best").alias("best"), F.max_by("row", "best").alias("row"), F.max_by("id", "best").alias("keep_id")),
        "dedup-entries",
    )
    depths = staged(spark, directory(entries, capacity), "dedup-directory")
    index = owned(entries, depths).drop("best")
    index.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key").write.parquet(path)
    return spark.read.schema(index.schema).parquet(path), depths


def may_share(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be in ``shared``; all that are, and a few others by chance.

    The bitmap has one bit for each prefix of a key, in words of 64 bits, of which those with a bit set are broadcast.
    """
    word = F.shiftrightunsigned("key", 64 - MAP_BITS + 6)
    bit = F.shiftrightunsigned("key", 64 - MAP_BITS).bitwiseAND(F.lit(63)).cast("int")
    words = shared.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    met = rows.join(F.broadcast(words), word == F.col("word"))
    return met.filter(F.call_function("shiftrightunsigned", F.col("bits"), bit).bitwiseAND(F.lit(1)) == 1).drop("word", "bits")


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = F.xxhash64,
    capacity: int = 100_000,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256`` and ``text_hash`` of the text as it stands.

    Texts are equal when they are identical without blanks. The row with the most code points stays, then the smallest
    id. Null text counts as empty; all empty texts are equal. A null id loses to any other. Of rows that repeat both id
    and text, one is kept. An empty table gives an empty result; other columns are ignored. ``hash_of`` may be any
    64-bit hash: texts that share its value are told apart by their bytes.
    """
    spark = df.sparkSession
    text = text_of(text_col)
    source = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("plain", normalised(F.col("text")))
    keys = staged(
        spark,
        source.select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.length("text").alias("chars"),
            F.xxhash64("text").alias("text_hash"),
            hash_of(F.col("plain")).alias("key"),
            F.sha2("plain", 256).alias("sha"),
        ),
        "dedup-keys",
    )
    index, depths = build_index(keys, new_dir(spark, "dedup-index"), capacity)

    # bytes are compared where a hash value has more than one row
    texts = source.select("plain", hash_of(F.col("plain")).alias("key"))
    compared = may_share(texts, index.filter("n > 1")).groupBy("key").agg(F.min("plain").alias("a"), F.max("plain").alias("b"))
    chained = staged(spark, compared.filter("a != b").select(F.col("key").alias("chained_key")), "dedup-chained")

    # the plain case: one text per hash value
    one_text = index.join(chained, F.col("key") == F.col("chained_key"), "left_anti")
    groups = one_text.select(F.col("bucket").alias("group_bucket"), F.col("key").alias("group_key"), "n", F.col("row").alias("keep_row"), "keep_id")
    plain = hot_join(owned(keys, depths), groups, {"bucket": "group_bucket", "key": "group_key"})
    columns = ["id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), "text_hash"]
    plain = plain.select(*columns)
    if chained.isEmpty():
        result = plain
    else:
        result = plain.unionByName(_chains(spark, source, chained, hash_of, columns))
    return result.withColumnRenamed("id", id_col)


def _chains(spark, source: DataFrame, chained: DataFrame, hash_of, columns: list) -> DataFrame:
    """Entries that share a hash value: the text itself is the key of the chain."""
    rows = staged(
        spark,
        source.withColumn("key", hash_of(F.col("plain")))
        .join(chained, F.col("key") == F.col("chained_key"), "left_semi")
        .select("id", "plain", F.length("text").alias("chars"), F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), F.sha2("plain", 256).alias("sha")),
        "dedup-chains",
    )
    groups = rows.withColumn("best", _best("chars", "id")).groupBy(F.col("plain").alias("group_plain")).agg(
        F.count("*").alias("n"), F.max_by("row", "best").alias("keep_row"), F.max_by("id", "best").alias("keep_id")
    )
    return hot_join(rows, groups, {"plain": "group_plain"}).select(*columns)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    A row is known by id and text, both null-safe, so rows that repeat an id with another text are not touched.
    """
    spark = docs.sparkSession
    found = staged(spark, exact_dedup(docs, id_col, text_col), "dedup-found")
    names = found.groupBy(F.col(id_col).alias("_dropped_id"), F.col("text_hash").alias("_dropped_hash")).agg(
        F.max("kept").alias("_any_kept"), F.count("*").alias("_rows")
    )
    marked = names.filter("_rows > 1 or not _any_kept")
    here = F.xxhash64(text_of(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_dropped_id")) & (here == F.col("_dropped_hash"))
    kept = docs.join(marked, same, "left_anti")
    again = staged(spark, marked.filter("_any_kept"), "dedup-repeated")
    if again.isEmpty():
        return kept
    repeated = docs.join(again, same, "left_semi").withColumn("_text_hash", here)
    return kept.unionByName(repeated.dropDuplicates([id_col, "_text_hash"]).drop("_text_hash"))
