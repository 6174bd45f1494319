"""Lempel-Ziv phrase fingerprints.

A text is parsed as LZ78 does: the longest phrase met before, with one more character, becomes a new phrase. The set of
phrases is hashed and its smallest hashes are the fingerprint, a bottom-k sketch; the likeness of two fingerprints
estimates the Jaccard similarity of the phrase sets, which follows how well one text compresses the other.

An edited text needs the document after its own in descending id order. The keys of all rows are range-sorted; the first
key of each range is a bound, so bounds are as many as ranges. Texts then go, packed, to their range, and the row that
is a bound goes to the range before as well. So every range holds the successor of its last row, texts are shuffled
once, and no range waits for another.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ROW, small_batches, staged, strings, text_of, with_row

#: Hashes in a fingerprint, of 32 bits each.
HASHES = 64

#: Text bytes of a range, and ranges at most: the list of bounds goes to every task. More text makes larger ranges.
RANGE_BYTES, RANGES = 8 << 20, 100_000

#: Characters with which the search for the end of a phrase begins.
_GUESS = 2


def parse(text: str, phrases: set[str], at: int, stop: int) -> int:
    """Add the LZ78 phrases of ``text[at:stop]`` that end before ``stop``; where the next phrase begins.

    Every prefix of a phrase is one, so the end of the longest known phrase is found by going up or down from a guess.
    """
    add = phrases.add
    while at < stop:
        end = at + _GUESS
        if end > stop:
            end = stop
        piece = text[at:end]
        if piece in phrases:
            while piece in phrases:
                if end == stop:
                    return at  # known to the end: open
                end += 1
                piece = text[at:end]
        else:
            while end > at + 1:
                shorter = text[at : end - 1]
                if shorter in phrases:
                    break
                piece, end = shorter, end - 1
        add(piece)
        at = end
    return at


def finish(text: str, phrases: set[str], at: int) -> set[str]:
    """Parse from ``at`` to the end; an unfinished phrase at the end is known already and adds nothing."""
    parse(text, phrases, at, len(text))
    return phrases


def sketch(phrases: set[str], hashes: int = HASHES) -> np.ndarray:
    """The smallest hashes of a set of phrases, ascending and different."""
    found = np.unique(np.fromiter(map(xxhash.xxh32_intdigest, phrases), np.uint32, len(phrases)))
    return found[:hashes]


def likeness(a: np.ndarray, b: np.ndarray, hashes: int = HASHES) -> float:
    """Share of the smallest hashes of both sets that both have; 1 for two empty sets."""
    union = np.union1d(a, b)[:hashes]
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def written(marks: np.ndarray) -> str:
    return marks.astype(">u4").tobytes().hex()


def read_marks(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def both_sketches(text: str, following: str, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of its edited form, whose common beginning is parsed once."""
    changed = edited(text, following)
    common = len(text) - len(text) // 2
    phrases: set[str] = set()
    at = parse(text, phrases, 0, common)
    other = finish(changed, set(phrases), at)
    return sketch(finish(text, phrases, at), hashes), sketch(other, hashes), changed


def _rank(id_: int | None, *rest: int) -> tuple:
    """Key in descending id order, null last."""
    return (id_ is None, 0 if id_ is None else -id_, *rest)


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """First key of each range of the sorted keys, ascending."""
    order = [F.col("id").desc_nulls_last(), F.col("hash"), *[F.col(c) for c in ROW]]
    dealt = keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            if not number:
                yield batch.slice(0, 1)

    return sorted(_rank(*r) for r in dealt.mapInArrow(first, dealt.schema).collect())


def _successive(rows: Iterator[tuple[int, int, int | None, str]], hashes: int) -> Iterator[tuple]:
    """Results of the rows ``(range, last, id, text)`` of some ranges; a row is done when its next row's fingerprint is."""
    before = here = None  # a row that lacks its next fingerprint, and the row after it, that lacks its next text
    for at, last, id_, text in rows:
        if here is not None:
            own, other, changed = both_sketches(here[1], text, hashes)
            if before is not None:
                yield (*before[0], likeness(before[1], own, hashes))
            digest = hashlib.sha256(changed.encode()).hexdigest()
            before = (here[0], len(here[1]), digest, written(own), written(other), likeness(own, other, hashes)), own
        here = (id_, text)
        if last:
            yield (*before[0], likeness(before[1], sketch(finish(text, set(), 0), hashes), hashes))
            before = here = None


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: int = HASHES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one after in descending id order, the first after the last; null ids come last, and rows
    that share an id stand in the order of their texts' hashes. A fingerprint is the hex form of at most ``hashes``
    32-bit hashes, ascending; an empty text has an empty one, which is like another empty one (1) and nothing else (0).
    Equal texts have equal fingerprints. Null text counts as empty; a table of one row is its own next; an empty table
    gives an empty result; other columns are ignored. Texts are parsed whole.
    """
    spark = df.sparkSession
    rows = with_row(df, "lempel-rows").select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), *ROW)
    source = rows.select("id", F.xxhash64("text").alias("hash"), *ROW, "text")
    keys = staged(spark, source.select("id", "hash", *ROW, F.octet_length("text").cast("long").alias("bytes")), "lempel-keys")
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    bounds = _bounds(keys.drop("bytes"), max(1, min(RANGES, -(-total // range_bytes))))
    starts, count = set(bounds), len(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in small_batches(batches, "text"):
            out: list[tuple] = []
            for *key, text in zip(*[batch[c].to_pylist() for c in ("id", "hash", *ROW)], strings(batch["text"]).to_pylist()):
                rank, data = _rank(*key), pack(text.encode())
                at = bisect_right(bounds, rank) - 1
                out.append((at, 0, *key, data))
                if rank in starts:
                    out.append(((at - 1) % count, 1, *key, data))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["range", "last", "id", "hash", *ROW, "data"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        rows = ((at, last, id_, unpack(data).decode()) for b in batches for at, last, id_, data in zip(*[b[c].to_pylist() for c in ("range", "last", "id", "data")]))
        found = _successive(rows, hashes)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        while part := list(islice(found, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    packed = source.mapInArrow(deal, f"range int, last int, id long, hash long, {ROW[0]} long, {ROW[1]} long, data binary")
    dealt = packed.repartitionById(max(1, count), F.col("range")).sortWithinPartitions("range", "last", F.col("id").desc_nulls_last(), "hash", *ROW)
    found = dealt.mapInArrow(work, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.withColumnRenamed("id", id_col)
