"""Phrase collocations by marginals of the longest windows.

Texts become pieces and pieces words. Lead columns put beside every word the words that follow it in its piece, padded
with the empty word at the piece's end, and only these longest windows are counted. What a shorter phrase counts is the
sum over all windows that begin with it, which is one ROLLUP of the counted windows: a word's windows sum to the word,
and all windows of a language to its number of words.

Most windows of a corpus are met once, so their shuffle is what costs. A task counts the windows of a group of texts,
sorts them and sends them as packed lines, one pack for each bucket; a bucket holds all windows with the same words but
the last, so that counts of windows and of their longest prefix are whole there. Windows below the least count then give
up their last word (no candidate and no part of one can be such a phrase), and what is left goes to ROLLUP. Nothing is
estimated: every count that is returned is a sum over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import and_, itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as csv
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches, staged, strings, text_of
from tidewater.operators.skew import hot_join

#: What ends a piece, and what stands between words.
ENDS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

#: What counts are as numbers whose products stay exact: up to 10^13 words.
EXACT = "decimal(13,0)"

#: Text bytes whose windows are counted together, and buckets that a task merges one after the other.
GROUP, BUCKETS = 8 << 20, 4

#: Parts of a language whose best phrases are found before those of the whole language.
PARTS = 16

#: The end of a piece among words: a byte that no UTF-8 text holds.
_END = b"\xff"
_LOWER = bytes.maketrans(bytes(range(65, 91)) + ENDS, bytes(range(97, 123)) + _END * len(ENDS))


def tokens(text: str, longest: int) -> list[bytes]:
    """Words in small letters with the end of each piece between them, and enough ends after the last."""
    return text.encode().translate(_LOWER).replace(_END, b" " + _END + b" ").split() + [_END] * longest


def count_windows(words: list[bytes], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words in order, the windows as columns of their numbers, in order, and the windows' counts.

    Windows are those of ``longest`` words that begin at a word; what lies beyond the end of a piece is the end mark.
    """
    coded = pa.array(words, pa.binary()).dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    codes, end = place[np.asarray(coded.indices)], len(order) - 1  # the end mark sorts last
    starts = np.flatnonzero(codes != end)
    columns = [codes[starts]]
    for j in range(1, longest):
        columns.append(np.where(columns[-1] == end, end, codes[np.minimum(starts + j, len(codes) - 1)]))
    base = len(order)
    if base**longest < 2**63:
        key = np.sort(reduce(lambda k, c: k * base + c, columns))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        windows = np.stack([key[first] // base ** (longest - 1 - j) % base for j in range(longest)])
    else:
        table = np.stack(columns)
        table = table[:, np.lexsort(table[::-1])]
        first = np.flatnonzero(np.concatenate(([True], (np.diff(table) != 0).any(0)))[: table.shape[1]])
        windows = table[:, first]
    return coded.dictionary.take(pa.array(order)), windows, np.diff(np.append(first, len(starts)))


def packs(words: list[bytes], lang: str, longest: int, buckets: int) -> Iterator[tuple[int, str, bytes]]:
    """``bucket, lang, pack``: counted windows as sorted lines, the end mark as the empty word."""
    names, windows, counts = count_windows(words, longest)
    if not len(counts):
        return
    marks = np.array([xxhash.xxh64_intdigest(w) for w in names.to_pylist()], np.uint64)
    bucket = np.full(len(counts), xxhash.xxh64_intdigest(lang), np.uint64)
    for column in windows[:-1]:
        bucket = (bucket ^ marks[column]) * np.uint64(0x9E3779B97F4A7C15)
        bucket ^= bucket >> np.uint64(29)
    bucket = (bucket % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    end = pa.scalar(b"", pa.binary())
    names = pc.if_else(pc.equal(names, _END), end, names)
    tail = pc.binary_join_element_wise(pa.array(counts[order]).cast(pa.string()), "", "\n").cast(pa.large_binary())
    lines = pc.binary_join_element_wise(*[names.take(pa.array(c[order])).cast(pa.large_binary()) for c in windows], tail, pa.scalar(b"\t", pa.large_binary()))
    ends = np.frombuffer(lines.buffers()[1], np.int64)[: len(lines) + 1]
    data, pack = memoryview(lines.buffers()[2]), zstandard.ZstdCompressor(level=3).compress
    at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(order)]):
        yield int(bucket[order[a]]), lang, pack(data[ends[a] : ends[b]])


def _sums(key: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of an ascending key and the sums of ``f`` over each."""
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(f, first) if len(first) else f[:0]


def merged(lang: str, found: list[bytes], longest: int, least: int) -> pa.RecordBatch:
    """The windows of a language in a bucket with their counts over all packs, in full where a phrase may need them.

    A window below ``least`` is summed with the others of its prefix, under the empty word; so is a prefix below it.
    """
    names = [f"w{j}" for j in range(1, longest + 1)]
    unpack = zstandard.ZstdDecompressor().decompress
    lines = csv.read_csv(
        pa.BufferReader(b"".join(map(unpack, found))),
        csv.ReadOptions(column_names=[*names, "f"], use_threads=False),
        csv.ParseOptions(delimiter="\t", quote_char=False, escape_char=False),
        csv.ConvertOptions(column_types={**{w: pa.large_string() for w in names}, "f": pa.int64()}, strings_can_be_null=False),
    )
    coded = pa.chunked_array([*(c for w in names for c in lines[w].chunks), pa.array([""], pa.large_string())]).combine_chunks().dictionary_encode()
    codes, base = np.asarray(coded.indices).astype(np.int64).reshape(-1), len(coded.dictionary)
    empty, columns = codes[-1], codes[:-1].reshape(longest, -1)
    prefix_key, window = columns[0], columns[-1]
    for column in columns[1:-1]:  # prefixes by number, so that no key passes 64 bits
        _, prefix_key = np.unique(prefix_key * base + column, return_inverse=True)
    order = np.argsort(prefix_key * base + window, kind="stable")
    key, f = _sums((prefix_key * base + window)[order], np.asarray(lines["f"])[order])
    at = order[np.searchsorted((prefix_key * base + window)[order], key)]  # a line of each window
    windows, prefix = columns[:, at], key // base
    _, whole = _sums(prefix, f)
    frequent = np.repeat(whole >= least, np.diff(np.append(np.flatnonzero(np.diff(prefix, prepend=-1)), len(prefix))))
    windows[-1, f < least] = empty
    windows[-2:, ~frequent] = empty
    rest = (f < least) | ~frequent
    # what was cut is summed by its first words, in a second pass over these rows alone
    cut = windows[:, rest]
    by = np.lexsort(cut[::-1])
    cut, cut_f = cut[:, by], f[rest][by]
    first = np.flatnonzero((np.diff(cut, axis=1, prepend=-1) != 0).any(0))
    cut, cut_f = cut[:, first], np.add.reduceat(cut_f, first) if len(first) else cut_f[:0]
    out, counts = np.concatenate((windows[:, ~rest], cut), axis=1), np.concatenate((f[~rest], cut_f))
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(counts)), *[coded.dictionary.take(pa.array(c)).cast(pa.string()) for c in out], pa.array(counts)], ["lang", *names, "f"])


def frequencies(docs: DataFrame, longest: int, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, size, phrase, f``: phrases of 1 to ``longest`` words that occur ``least`` times or more; size 0 is all words."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = tasks * BUCKETS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [r for lang, words in held.items() for r in packs(words, lang, longest, buckets)]
            held.clear()
            columns = zip(*rows) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.string(), pa.binary()))], ["bucket", "lang", "pack"])

        for batch in small_batches(batches, "text", GROUP):
            for text, lang in zip(strings(batch["text"]).to_pylist(), batch["lang"].to_pylist()):
                held.setdefault(lang, []).extend(tokens(text, longest))
                size += len(text)
                if size >= GROUP:
                    yield flush()
                    size = 0
        if size or held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[batch[c].to_pylist() for c in ("bucket", "lang", "pack")]))
        for (_, lang), packs_of in groupby(rows, key=itemgetter(0, 1)):
            yield merged(lang, [data for *_, data in packs_of], longest, least)

    names = [f"w{j}" for j in range(1, longest + 1)]
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    packed = texts.mapInArrow(pack, "bucket int, lang string, pack binary")
    dealt = packed.repartitionById(tasks, F.pmod("bucket", F.lit(tasks))).sortWithinPartitions("bucket", "lang")
    counted = dealt.mapInArrow(merge, ", ".join(f"{c} string" for c in ("lang", *names)) + ", f long")
    summed = counted.rollup("lang", *names).agg(F.sum("f").alias("f"), F.grouping_id().alias("summed_up"))
    size = F.lit(longest) - F.bit_count("summed_up")  # -1: the total of all languages
    present = reduce(and_, [(F.lit(j) > F.col("size")) | (F.col(f"w{j}") != "") for j in range(1, longest + 1)])
    kept = summed.withColumn("size", size).filter((F.col("size") >= 0) & ((F.col("size") == 0) | (F.col("f") >= least)) & present)
    return kept.select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "f")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    share: int = 50,
    best: int | None = 2000,
    scale: int = 1_000_000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``best`` phrases (None: all).

    A candidate has 2 to ``longest`` words and occurs ``a >= least`` times. Its cut with the lowest score
    ``floor(scale * a * a / (l * r))`` counts, ties to the shortest first part. A candidate goes if it stands inside a
    longer one with ``100 * f >= share * a``. Null text counts as empty, a null language is ``und``; texts without words
    add nothing; rows that repeat are counted each; an empty table gives an empty result; other columns are ignored.
    Counts beyond 10^13 raise an error.
    """
    counts = staged(docs.sparkSession, frequencies(docs, longest, least, text_col, lang_col), "phrase-counts")
    phrases = counts.filter("size > 0")
    candidates = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", part(F.lit(1), k).alias("first"), part(k + 1, F.col("size") - k).alias("rest"))
    count_of = lambda key, name: phrases.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(key), F.col("f").alias(name))
    for name, column in (("l", "first"), ("r", "rest")):
        cuts = hot_join(cuts, count_of(f"{name}_phrase", name), {"lang": f"{name}_lang", column: f"{name}_phrase"}).drop(f"{name}_lang", f"{name}_phrase")
    a, left, right = (F.col(c).cast(EXACT) for c in ("a", "l", "r"))
    cuts = cuts.withColumn("above", F.lit(scale).cast("decimal(7,0)") * (a * a)).withColumn("below", left * right).withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the largest count of a longer candidate around each shorter one
    inside = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: part(i, m)))))
    around = candidates.filter("size > 2").select(F.col("lang").alias("in_lang"), inside.alias("in_phrase"), F.col("a").alias("f"))
    around = around.groupBy("in_lang", "in_phrase").agg(F.max("f").alias("longer"))
    scored = scored.join(around, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("in_phrase")), "left")
    scored = scored.filter(F.coalesce(F.col("longer").cast(EXACT) * 100 < F.col("a").cast(EXACT) * share, F.lit(True)))

    total = counts.filter("size = 0").select(F.col("lang").alias("of_lang"), F.col("f").alias("n"))  # one row per language
    found = hot_join(scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), total, {"lang": "of_lang"})
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if best is not None:  # the best of each part of a language, so that few rows of it meet in one task
        parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
        found = found.withColumn("in_part", F.row_number().over(parts)).filter(F.col("in_part") <= best).drop("in_part")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
