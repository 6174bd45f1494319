"""Words of text without blanks: a trie of known words, a lattice of where they stand, and its cheapest path.

A word costs the negative logarithm of its share of all words, learned from a table of texts. A character that begins no
cheaper word costs more than any known one; such characters that follow one another are given back as one token. Costs
are whole millionths, so that the cheapest path does not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import SEPARATORS, tokens

#: Words of a model at most: it is sent to every worker.
LARGEST = 500_000
#: Texts whose words are held as Python objects at a time.
SLICE = 50


def word_costs(texts: DataFrame, text: Column, size: int = 50_000, longest: int = 24) -> DataFrame:
    """``word, n, total``: the ``size`` most frequent words of the texts, in small letters and of at most ``longest`` characters.

    ``total`` counts all words. Counting covers every text; only the dictionary that is kept is bounded.
    """
    words = texts.select(F.explode(tokens(F.lower(text))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.length("word") <= longest).orderBy(F.desc("n"), "word").limit(size).withColumn("total", total)


class Lattice:
    """Trie of the known words with their costs."""

    def __init__(self, costs: dict[str, int], unknown: int):
        self.unknown = unknown
        self.children: list[dict[str, int]] = [{}]
        self.costs: list[int | None] = [None]
        for word, cost in costs.items():
            node = 0
            for c in word:
                found = self.children[node].get(c)
                if found is None:
                    found = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.costs.append(None)
                node = found
            self.costs[node] = cost

    def best(self, text: str) -> list[str]:
        """Words on the cheapest path; of equal ones that with the fewest steps, then with the longest last word and so on."""
        n = len(text)
        reached: list[tuple[int, int] | None] = [None] * (n + 1)
        came, known = [0] * (n + 1), [False] * (n + 1)
        reached[0] = (0, 0)
        children, costs = self.children, self.costs
        for start in range(n):
            cost, steps = reached[start]
            steps += 1
            offer = (cost + self.unknown, steps)
            if reached[start + 1] is None or offer < reached[start + 1]:
                reached[start + 1], came[start + 1], known[start + 1] = offer, start, False
            node, end = 0, start
            while end < n:
                node = children[node].get(text[end])
                if node is None:
                    break
                end += 1
                if costs[node] is not None:
                    offer = (cost + costs[node], steps)
                    if reached[end] is None or offer < reached[end]:
                        reached[end], came[end], known[end] = offer, start, True
        words, end = [], n
        while end > 0:
            start, of = came[end], known[end]
            while not of and start > 0 and not known[start]:
                start = came[start]  # unknown characters side by side
            words.append(text[start:end])
            end = start
        return words[::-1]


def lattice_of(rows: list[tuple[str, int, int]]) -> Lattice:
    """Lattice of ``(word, n, total)``; an unknown character is dearer than a word seen once."""
    total = rows[0][2] if rows else 1
    return Lattice({word: round(1e6 * log(total / n)) for word, n, total in rows}, round(1e6 * (log(total) + 1)))


_built: dict[int, Lattice] = {}


def _cutter(model: DataFrame):
    """Arrow UDF that cuts the pieces of a text; a worker builds the lattice of a model once.

    Words are objects of Python for ``SLICE`` texts at a time only; what a batch holds otherwise is Arrow.
    """
    spark = model.sparkSession
    rows = sorted(tuple(r) for r in model.select("word", "n", "total").limit(LARGEST + 1).collect())
    if len(rows) > LARGEST:
        raise ValueError(f"a model may hold {LARGEST} words")
    shared, name = spark.sparkContext.broadcast(rows), crc32(repr(rows).encode())

    @F.arrow_udf("array<string>")
    def cut(pieces: pa.Array) -> pa.Array:
        if name not in _built:
            _built.clear()
            _built[name] = lattice_of(shared.value)
        best, kind, done = _built[name].best, pa.list_(pa.string()), []
        for at in range(0, len(pieces), SLICE):
            texts = pieces.slice(at, SLICE).to_pylist()
            done.append(pa.array([None if text is None else [word for piece in text for word in best(piece)] for text in texts], kind))
        return pa.concat_arrays(done) if done else pa.array([], kind)

    return cut


def segmenter(model: DataFrame) -> Callable[[Column], Column]:
    """A tokenizer for ``explode_tokens``: words of a text in small letters, cut at separators and then by the lattice.

    ``model`` is the result of ``word_costs``, of at most ``LARGEST`` words. A null text stays null, an empty one or one
    of separators has no words; with an empty model the pieces between separators are the words.
    """
    cut = _cutter(model)
    return lambda text: cut(tokens(F.lower(text)))


def register_segmenter(spark: SparkSession, model: DataFrame, name: str = "segmented") -> None:
    """The segmenter as a SQL function of the pieces of a text: ``LATERAL VIEW explode(name(PIECES))``."""
    spark.udf.register(name, _cutter(model))


#: Pieces of the column ``body`` for the registered function.
PIECES = "filter(split(lower(body), r'" + SEPARATORS + "'), w -> w <> '')"
