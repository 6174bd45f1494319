"""Token ids of a corpus in binary files, in ascending id order.

Texts are tokenised once into a staged table; the token counts of the whole table make the shared frequency table. Range
partitions in id order become files of independent blocks. A task writes under a temporary name and reports its blocks;
what Spark kept of the reports is the manifest, by which files get their names. Decoding goes block by block from the
manifest, so its parallelism does not depend on the files.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, commit_file, join_pieces, open_shared, small_batches, staged, strings
from tidewater.llm.rans import Block, Table, encode_block
from tidewater.session import new_dir

#: Words that a worker remembers at most in each of two sets, and tokens of a block; a longer document is a block of its own.
REMEMBERED = 300_000
BLOCK = 1 << 20

#: Letters and digits, and punctuation, between which the tokenizer's pattern always cuts. The apostrophe
#: is left out, as it may begin a contraction.
LETTER = r"[A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]"
MARK = r"[!-&(-/:-@\[-`{-~]"

MANIFEST = "shard int, block int, offset long, bytes long, tokens long, documents long, temporary string, file string"

_loaded: dict[str, tuple] = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = (Tokenizer.from_file(path), [{}, {}])
    return _loaded[path]


def _encoded(words: list[str], path: str) -> list[bytes]:
    """The ids of different words as bytes.

    Known words are kept in two sets. When the newer is full it becomes the older one, whose words are lost unless they
    are met again before the next change, so that frequent words stay.
    """
    tokenizer, known = _tokenizer(path)
    pieces = list(map(known[0].get, words))
    missing = [i for i, piece in enumerate(pieces) if piece is None]
    for at in range(0, len(missing), 10_000):
        part = missing[at : at + 10_000]
        if len(known[0]) >= REMEMBERED:
            known[:] = {}, known[0]
        newer, older = known
        new = []
        for i in part:
            piece = pieces[i] = older.get(words[i])
            if piece is None:
                new.append(i)
            else:
                newer[words[i]] = piece
        for i, encoding in zip(new, tokenizer.encode_batch_fast([words[i] for i in new], add_special_tokens=False)):
            pieces[i] = newer[words[i]] = array("I", encoding.ids).tobytes()
    return pieces


def encode_texts(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array with ``end_id`` after each, and their numbers.

    The tokenizer drops white space before it merges, so no token crosses a blank and every different word is encoded
    once. To have fewer different words, letters become small first, as the tokenizer would make them, and a blank is
    set where its pattern cuts anyway. Texts that may hold the name of a special token are left as they are, and so are
    texts with a combining mark, which the tokenizer composes with the letter before it before letters become small.
    """
    apart = pc.replace_substring_regex(pc.ascii_lower(texts), f"({LETTER})({MARK})", r"\1 \2")
    apart = pc.replace_substring_regex(apart, f"({MARK})({LETTER})", r"\1 \2")
    plain = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, r"\pM"))
    split = pc.ascii_split_whitespace(pc.if_else(plain, texts, apart))
    words = split.flatten().dictionary_encode()
    pieces = _encoded(words.dictionary.to_pylist(), path)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
    starts = np.cumsum(sizes) - sizes
    codes = np.asarray(words.indices).astype(np.int64)
    flat = join_pieces(np.frombuffer(b"".join(pieces), np.uint32), starts[codes], sizes[codes])
    ends = np.concatenate(([0], np.cumsum(sizes[codes])))[np.cumsum(np.asarray(pc.list_value_length(split)), dtype=np.int64)]
    ids = np.insert(flat, ends, end_id)
    counts = np.diff(np.concatenate(([0], ends))) + 1
    return ids.astype(np.uint32), counts


def tokenised(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, tokens, ids``: ids as little-endian 16-bit integers, or 32-bit ones for a large vocabulary."""
    width = "<u2" if _tokenizer(path)[0].get_vocab_size() <= 1 << 16 else "<u4"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 8 << 20):
            ids, counts = encode_texts(strings(batch["text"]), path, end_id)
            ends = np.concatenate(([0], np.cumsum(counts))) * int(width[-1])
            data = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.astype(width))])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(counts), pa.array(np.full(len(counts), int(width[-1]), np.int32)), data], ["id", "tokens", "width", "ids"])

    bound_batches(df.sparkSession)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(work, "id long, tokens long, width int, ids binary")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of ``tokenised`` and their numbers."""
    data = batch["ids"]
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(data) and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    width = batch["width"][0].as_py() if len(data) else 2
    return raw.view(f"<u{width}"), np.asarray(batch["tokens"])


def count_tokens(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every token over the whole table; one number per token reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            counts += np.bincount(_numbers(batch)[0], minlength=vocabulary)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["token", "n"])

    counts = np.zeros(vocabulary, np.int64)
    sums = tokens.select("tokens", "width", "ids").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts[sums["token"].to_numpy()] = sums["n"].to_numpy()
    return counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list]]:
    """Whole documents in groups of about ``BLOCK`` tokens."""
    held, documents, size = [], [], 0
    for batch in batches:
        ids, counts = _numbers(batch)
        ends = np.cumsum(counts)
        for row, (name, end, n) in enumerate(zip(batch["id"].to_pylist(), ends.tolist(), counts.tolist())):
            if size and size + n > BLOCK:
                yield np.concatenate(held), documents
                held, documents, size = [], [], 0
            held.append(np.array(ids[end - n : end], np.uint32))
            documents.append((name, n))
            size += n
    if documents:
        yield np.concatenate(held), documents


def write_token_files(tokens: DataFrame, folder: str, table: Table) -> DataFrame:
    """Write the files and give their manifest, one row per block."""
    spark = tokens.sparkSession
    frequencies = table.to_bytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Table.from_bytes(frequencies)
        shard = TaskContext.get().partitionId()
        fs, base = open_shared(folder)
        final = f"{base}/tokens-{shard:06d}.rans"
        temporary = f"{base}/_temporary/{shard:06d}-{uuid.uuid4().hex}"
        rows, offset, out = [], 0, None
        for number, (ids, documents) in enumerate(_blocks(batches)):
            if out is None:
                fs.create_dir(f"{base}/_temporary", recursive=True)
                out = fs.open_output_stream(temporary)
            data = encode_block(shared, ids, documents)
            out.write(data)
            rows.append((shard, number, offset, len(data), len(ids), len(documents), temporary, final))
            offset += len(data)
        if out is not None:
            out.close()
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_shared(folder)
        for batch in batches:
            for temporary, final in zip(batch["temporary"].to_pylist(), batch["file"].to_pylist()):
                commit_file(fs, temporary, final)
            yield batch

    order = ["id", "tokens", "ids_hash"]  # so that rows without an id, or of one id, are many ranges
    ordered = tokens.withColumn("ids_hash", F.xxhash64("ids")).repartitionByRange(*order).sortWithinPartitions(*order)
    report = staged(spark, ordered.mapInArrow(work, MANIFEST), "token-report")
    files = report.select("temporary", "file").distinct()
    staged(spark, files.mapInArrow(commit, files.schema), "token-commit")
    fs, base = open_shared(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/frequencies.bin") as out:
        out.write(frequencies)
    report.drop("temporary").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: ``id, start, n_tokens, ids_crc32, ids``, decoded from the files.

    ``start`` counts the tokens of all documents before it in id order; ``ids`` are little-endian 32-bit integers.
    """
    fs, base = open_shared(folder)
    with fs.open_input_file(f"{base}/frequencies.bin") as source:
        frequencies = source.read()
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    shards = manifest.groupBy(F.col("shard").alias("shard_no")).agg(F.sum("tokens").alias("n"))
    shards = shards.select("shard_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = manifest.withColumn("inner", F.coalesce(F.sum("tokens").over(inner), F.lit(0)))
    blocks = blocks.join(shards, F.col("shard") == F.col("shard_no")).select("file", "offset", "bytes", (F.col("base") + F.col("inner")).alias("start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Table.from_bytes(frequencies)
        fs, _ = open_shared(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["file"]) as source:
                    source.seek(row["offset"])
                    block = Block(source.read(row["bytes"]), shared)
                ids = block.ids().astype("<u4")
                ends = np.concatenate(([0], np.cumsum(block.lengths)))
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                data = pa.Array.from_buffers(pa.binary(), len(crcs), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.document_ids, pa.int64()), pa.array(row["start"] + ends[:-1]), pa.array(block.lengths.astype(np.int64)), pa.array(crcs, pa.int64()), data],
                    ["id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    # a manifest is small, so its bytes say nothing about the work: the number of tasks follows the blocks
    dealt = blocks.repartition(max(1, manifest.count() // 4), "file", "offset")
    return dealt.mapInArrow(work, "id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_files(df: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Encode a corpus into token files and read it back: ``id, start, n_tokens, ids_crc32, ids``.

    Null text counts as empty and is its end id alone; null ids come first in order; rows that repeat an id stand side
    by side, the shorter first, then by a hash of their ids; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    folder = folder or new_dir(spark, "token-files")
    tokens = tokenised(df, path, end_id, id_col, text_col)
    staging = new_dir(spark, "tokens")
    tokens.write.option("compression", "zstd").parquet(staging)
    tokens = spark.read.schema(tokens.schema).parquet(staging)
    vocabulary = max(_tokenizer(path)[0].get_vocab_size(), end_id + 1)
    table = Table.from_counts(count_tokens(tokens, vocabulary))
    write_token_files(tokens, folder, table)
    return read_token_files(spark, folder).withColumnRenamed("id", id_col)
