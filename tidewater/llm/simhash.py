"""SimHash near-dedup by multi-index hashing.

A fingerprint is the majority of the bits of its shingles' hashes. Different fingerprints are cut into two segments of
32 bits. Two fingerprints that differ in at most 4 bits differ in at most 2 bits of one segment, so their Hamming balls
of radius 1 in that segment share a point: every fingerprint enters the table of its segment at the 33 points of its
ball, rows that meet at a point are the table matches, and each match is verified on all 64 bits.

A point is one key of a shuffle. The rows of a point are different fingerprints; a point where many meet (a large group
of near copies) is spread over sub-tables on the other segment before any task sees it, and inside a task the links of
a point are reduced to a spanning forest. Rows per fingerprint are fixed, so the work grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ROW, bound_batches, small_batches, staged, strings, text_of, with_row
from tidewater.llm.components import components
from tidewater.operators.skew import hot_join

#: Differing bits that still link, and bits of a segment.
RADIUS, SEGMENT = 4, 32

#: Rows of a point beyond which its rows go to sub-tables.
CROWDED = 2_000

#: Fingerprints that one task enters into the tables.
ENTERED = 10_000


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of every run of ``width`` words, of the whole sequence if it is shorter, of nothing if there is no word."""
    words = text.split()  # bytes.split() cuts at exactly the six blanks
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], 42) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half of the hashes; zero for no hash."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], np.uint64).astype(">u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, bits``: the 64-bit fingerprint of each text as a long; beside them the columns ``keep``, which are longs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            bits = [fingerprint(shingle_hashes(t.encode().translate(_LOWER), width)) for t in strings(batch["text"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(np.array(bits, np.uint64).view(np.int64)), *[batch[c] for c in keep]], ["id", "bits", *keep])

    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *keep)
    bound_batches(df.sparkSession)
    return source.mapInArrow(work, ", ".join(f"{c} long" for c in ("id", "bits", *keep)))


def table_entries(marks: DataFrame) -> DataFrame:
    """``segment, point, bits``: every fingerprint at the points of its ball in both segments."""
    part = lambda s: F.shiftrightunsigned("bits", SEGMENT * s).bitwiseAND(F.lit((1 << SEGMENT) - 1))
    ball = F.array(F.lit(0).cast("long"), *[F.lit(1 << b) for b in range(SEGMENT)])
    each = marks.select("bits", F.posexplode(F.array(part(0), part(1))).alias("segment", "own"))
    return each.select("segment", F.explode(F.transform(ball, lambda m: F.col("own").bitwiseXOR(m))).alias("point"), "bits")


def _forest(bits: np.ndarray) -> np.ndarray:
    """Edges (parent, child) of a spanning forest of the fingerprints within the radius, by breadth first search."""
    left = np.unique(bits)
    edges = []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            parent = np.zeros(len(left), np.uint64)
            for one in front:
                hit = ~near & (np.bitwise_count(left ^ one) <= RADIUS)
                parent[hit] = one
                near |= hit
            edges.append(np.stack([parent[near], left[near]], 1))
            front, left = left[near], left[~near]
    return np.concatenate(edges) if edges else np.empty((0, 2), np.uint64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of rows sorted by their key; a key may run over batches, pairs and triples are done at once."""
    held_keys = np.empty((0, 2), np.int64)
    held = np.empty(0, np.uint64)

    def emit(keys: np.ndarray, bits: np.ndarray):
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        starts = np.concatenate(([0], cut))
        sizes = np.diff(np.concatenate((starts, [len(bits)])))
        edges = []
        for size in (2, 3):
            at = starts[sizes == size]
            for a, b in combinations(range(size), 2):
                pair = np.stack([bits[at + a], bits[at + b]], 1)
                edges.append(pair[np.bitwise_count(pair[:, 0] ^ pair[:, 1]) <= RADIUS])
        for a, n in zip(starts[sizes > 3].tolist(), sizes[sizes > 3].tolist()):
            edges.append(_forest(bits[a : a + n]))
        found = np.concatenate(edges)
        found = np.unique(found[found[:, 0] != found[:, 1]], axis=0)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([held_keys, np.stack([np.asarray(batch["k1"]), np.asarray(batch["k2"])], 1)])
        bits = np.concatenate([held, np.asarray(batch["bits"]).view(np.uint64)])
        last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last:
            yield from emit(keys[:last], bits[:last])
        held_keys, held = keys[last:], bits[last:]
    if len(held):
        yield from emit(held_keys, held)


def links(marks: DataFrame) -> DataFrame:
    """``a, b``: for different fingerprints (``bits``), edges that connect whatever differs in at most 4 bits."""
    spark = marks.sparkSession
    # a fingerprint is 8 bytes and 66 rows: the number of tasks follows the rows, not the bytes
    entries = table_entries(marks.repartition(max(1, marks.count() // ENTERED), "bits"))
    counts = staged(spark, entries.groupBy("segment", "point").count().filter(F.col("count") > CROWDED).select(F.col("segment").alias("at_segment"), F.col("point").alias("at_point")), "simhash-crowded")
    key = (F.col("point") * 2 + F.col("segment")).alias("k1")
    plain = entries.select(key, F.lit(0).cast("long").alias("k2"), "bits")
    if not counts.isEmpty():
        at = (F.col("segment") == F.col("at_segment")) & (F.col("point") == F.col("at_point"))
        crowded = entries.join(counts, at).drop("at_segment", "at_point")
        plain = entries.join(counts, at, "left_anti").select(key, F.lit(0).cast("long").alias("k2"), "bits")
        # of 8 pieces of 4 bits of the other segment at most 4 differ: some 4 pieces agree, and each choice of 4 is a sub-table
        high = F.shiftrightunsigned("bits", SEGMENT)
        other = F.when(F.col("segment") == 0, high).otherwise(F.col("bits").bitwiseAND(F.lit((1 << SEGMENT) - 1)))
        masks = [sum(15 << (4 * p) for p in kept) for kept in combinations(range(8), 4)]
        table = F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("sub", "mask")
        split = crowded.withColumn("other", other).select("*", table)
        plain = plain.unionByName(
            split.select(key, (F.col("sub") * (1 << SEGMENT) + F.col("other").bitwiseAND(F.col("mask")) + 1).alias("k2"), "bits")
        )
    dealt = plain.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return dealt.mapInArrow(_links, "a long, b long")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """One row per input row: ``id, fingerprint, component_id``; the component is named by its smallest id.

    Texts link at 4 or fewer differing bits, and links chain. Null text counts as empty; texts without words have the
    fingerprint zero and link like others. A null id takes part and is named only if a component has no other; rows that
    repeat share a component. An empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    prints = staged(spark, fingerprints(df, id_col, text_col, width), "simhash-prints")
    marks = staged(spark, prints.groupBy("bits").agg(F.min("id").alias("least")), "simhash-marks")
    edges = staged(spark, links(marks.select("bits")), "simhash-links")
    classes = components(edges, marks.select("bits", "least"), "bits", "least")
    named = staged(spark, classes.select(F.col("bits").alias("mark"), "component"), "simhash-named")
    joined = hot_join(prints, named, {"bits": "mark"})
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return joined.select(F.col("id").alias(id_col), hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component of ``near_dedup``, with all columns.

    The smallest id stays, a null id last; of equal ids the smallest hash of the text. Rows are told apart by their
    place in the table, so an id that repeats with another text, or is null, neither takes a row along nor spares one.
    """
    spark = docs.sparkSession
    rows = with_row(docs, "simhash-rows")
    hashed = rows.withColumn("_text_hash", F.xxhash64(text_of(text_col)))
    prints = staged(spark, fingerprints(hashed, id_col, text_col, keep=("_text_hash", *ROW)), "simhash-prints")
    marks = staged(spark, prints.select("bits").distinct(), "simhash-marks")
    edges = staged(spark, links(marks), "simhash-links")
    named = staged(spark, components(edges, marks, "bits", "bits").withColumnRenamed("bits", "mark"), "simhash-named")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "_text_hash", *ROW)
    grouped = staged(spark, hot_join(prints, named, {"bits": "mark"}).select("component", order.alias("order")), "simhash-grouped")
    firsts = grouped.groupBy(F.col("component").alias("of")).agg(F.min("order").alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = hot_join(grouped, firsts, {"component": "of"}).filter("order != first").select(*[F.col(f"order.{c}").alias(f"_gone{c}") for c in ROW])
    gone = staged(spark, gone, "simhash-gone")
    same = [F.col(c) == F.col(f"_gone{c}") for c in ROW]
    return rows.join(gone, same, "left_anti").drop(*ROW)
