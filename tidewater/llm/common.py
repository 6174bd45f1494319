"""What the operators share: staged tables, safe text columns, files in the shared folder, values in Arrow form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import new_dir

#: The white space that separates words, as a character class of a regular expression.
BLANKS = r"\x20\x09-\x0D"


#: Bytes of rows that travel to a Python worker at a time, and the option that says so, with Spark's own value.
BATCH_BYTES, BATCH_OPTION, BATCH_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let batches of text end at ``BATCH_BYTES``, unless the session has a value of its own.

    A task holds a batch in Spark, on its way and in its Python worker. The option counts when a plan is run, so it stays.
    """
    if spark.conf.get(BATCH_OPTION) == f"{BATCH_DEFAULT}b":
        spark.conf.set(BATCH_OPTION, f"{BATCH_BYTES}b")


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it back, so that no later step or lost executor repeats the work."""
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Columns that name a row: its file, by a 64-bit hash of the path, and its place there.
ROW = ("_row_file", "_row_index")


def with_row(df: DataFrame, label: str) -> DataFrame:
    """The table with the columns ``ROW``, equal at every read; unlike ids they are never null and never repeat.

    A plain read of Parquet files has them without a copy; any other table is written first.
    """
    spark = df.sparkSession
    if df._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        try:
            return _named_rows(df)
        except AnalysisException:  # no files, or files that do not number their rows
            pass
    return _named_rows(staged(spark, df, label))


def _named_rows(df: DataFrame) -> DataFrame:
    return df.select("*", F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def open_shared(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share; a plain path is a shared mount."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def commit_file(fs: pafs.FileSystem, temporary: str, final: str) -> None:
    """Give a finished file its name; a second call after a lost executor finds it done."""
    if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
        fs.move(temporary, final)
    elif fs.get_file_info(final).type == pafs.FileType.NotFound:
        raise FileNotFoundError(final)


def strings(column: pa.Array) -> pa.Array:
    """Text of a batch with nulls as empty, as large strings, so that a batch may pass 2 GiB."""
    return column.cast(pa.large_string()).fill_null("")


def join_pieces(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[starts[i] : starts[i] + lengths[i]]`` for all i, without a loop."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = starts - np.concatenate(([0], np.cumsum(lengths[:-1])))
    return values[np.repeat(shift, lengths) + np.arange(total)]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each stays near ``limit`` bytes; a single longer text is a batch of its own.

    The pieces are copies: some string functions of Arrow take a slice's offsets for those of its whole array.
    """
    for batch in batches:
        sizes = np.asarray(pc.binary_length(strings(batch[column])))
        group = (np.cumsum(sizes) - sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.take(pa.array(np.arange(a, b)))
