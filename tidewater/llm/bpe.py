"""Byte-level BPE by merge replay over the corpus of a batch.

Texts are split by the pattern into words; every different word is worked on once. The words' tokens stand in one array,
and beside each position the rank of the pair that begins there. From it an inverted index is made in waves: it leads
from a pair's rank to the positions where that pair is the next merge of its word. A wave merges all of them in rank
order and looks up again only the pairs beside them. Words do not touch one another, so each sees its merges in the
order in which the public encoder applies them, and a wave is a few array operations over all words at once. Words too
long for waves are replayed by a heap of ranks over an index of their positions.

Words already encoded are remembered by the Python worker up to a bound. A corpus is the batch and not the whole table:
to share words between tasks, each occurrence would have to be shuffled to its word and back.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, small_batches, strings

#: Words that a worker remembers at most, and bytes of a word from which the heap is the faster way.
REMEMBERED, LONG = 250_000, 1000

#: Bytes of text whose words are Python objects and arrays at a time; texts longer than that stand alone.
TOGETHER = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Replay:
    """Merges of one vocabulary, replayed over sets of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.top = top = max(ranks.values()) + 1
        lengths = np.zeros(top, np.int64)
        for rank, token in self.tokens.items():
            lengths[rank] = len(token)
        self.token_lengths = lengths
        self.token_bytes = pa.array([self.tokens.get(i, b"") for i in range(top)], pa.large_binary())

        # every pair of tokens that makes a token, by one number; ``top`` stands for no merge
        keys, made = array("q"), array("q")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None:
                    keys.append(a * top + b)
                    made.append(rank)
        keys, made = np.array(keys, np.int64), np.array(made, np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = np.append(keys[order], top * top), np.append(made[order], top)
        ids = np.array(self.byte_ids, np.int64)
        self.byte_table = ids
        self.byte_pairs = self.made(np.repeat(ids, 256), np.tile(ids, 256)).reshape(256, 256)

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that pairs of tokens make, or ``top``."""
        key = left * self.top + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_made[at], self.top)

    def rank_of(self, left: int, right: int) -> int:
        """Rank of the token that two tokens make, or -1."""
        return self.ranks.get(self.tokens[left] + self.tokens[right], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of every word, as 32-bit integers."""
        found: list[bytes | None] = [None] * len(words)
        short, long = [], []
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            else:
                (short if len(word) < LONG else long).append(i)
        for some, replay in ((short, self.replay_in_waves), (long, self.replay_by_heap)):
            for i, ids in zip(some, replay([words[i] for i in some])):
                found[i] = ids
        return found

    def replay_in_waves(self, words: list[bytes]) -> list[bytes]:
        """The words replayed together; each wave applies the next merge of every word."""
        data = np.frombuffer(b"".join(words), np.uint8)
        if not len(data):
            return [b""] * len(words)
        symbols = self.byte_table[data]
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        rank = np.full(len(data), self.top)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.byte_pairs[data[:-1], data[1:]], self.top)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(owner):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(rank, starts)
            if (lowest == self.top).any():
                open_ = np.repeat(lowest < self.top, sizes)
                done.append((owner[~open_], symbols[~open_]))
                owner, symbols, rank = owner[open_], symbols[open_], rank[open_]
                sizes, lowest = sizes[lowest < self.top], lowest[lowest < self.top]
            places = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # of pairs that overlap, the first, third and so on are merged
            number = np.arange(len(places))
            chain = np.maximum.accumulate(np.where(np.diff(places, prepend=-2) != 1, number, 0))
            places = places[(number - chain) % 2 == 0]
            index = places[np.argsort(rank[places], kind="stable")]  # positions by rank
            symbols[index] = rank[index]
            stays = np.ones(len(owner), bool)
            stays[index + 1] = False
            at = index - (np.cumsum(~stays))[index]
            owner, symbols, rank = owner[stays], symbols[stays], rank[stays]
            touched = np.concatenate((at, at[at > 0] - 1))
            beside = np.minimum(touched + 1, len(owner) - 1)
            same = (owner[beside] == owner[touched]) & (beside > touched)
            rank[touched] = np.where(same, self.made(symbols[touched], symbols[beside]), self.top)
        owner, symbols = (np.concatenate(c) for c in zip(*done))
        flat = symbols[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def replay_by_heap(self, words: list[bytes]) -> list[bytes]:
        """The words replayed rank by rank, for words in which one wave after the other would cost too much."""
        symbols: list[int] = []
        owner: list[int] = []
        spans = []
        for w, word in enumerate(words):
            spans.append((len(symbols), len(symbols) + len(word)))
            symbols += [self.byte_ids[b] for b in word]
            owner += [w] * len(word)
        n = len(symbols)
        after = list(range(1, n + 1))  # next position of the same word, or -1
        before = list(range(-1, n - 1))
        for a, b in spans:
            if b > a:
                before[a], after[b - 1] = -1, -1
        index: dict[int, list[int]] = {}
        rank_of = self.rank_of
        for a, b in spans:
            for at in range(a, b - 1):
                rank = rank_of(symbols[at], symbols[at + 1])
                if rank >= 0:
                    index.setdefault(rank, []).append(at)
        waiting = list(index)
        heapq.heapify(waiting)
        while waiting:
            rank = heapq.heappop(waiting)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            sent_back = -1  # a word with a lower pair to be merged first
            for at in places:
                right = after[at]
                if symbols[at] < 0 or right < 0 or rank_of(symbols[at], symbols[right]) != rank:
                    continue
                if owner[at] == sent_back:
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(waiting, rank)
                    index[rank].append(at)
                    continue
                beyond, left = after[right], before[at]
                symbols[at], symbols[right], after[at] = rank, -1, beyond
                if beyond >= 0:
                    before[beyond] = at
                    found = rank_of(rank, symbols[beyond])
                    if found >= 0:
                        if found not in index:
                            index[found] = []
                            heapq.heappush(waiting, found)
                        index[found].append(at)
                        if found < rank:
                            sent_back = owner[at]
                if left >= 0:
                    found = rank_of(symbols[left], rank)
                    if found >= 0:
                        if found not in index:
                            index[found] = []
                            heapq.heappush(waiting, found)
                        index[found].append(left)
                        if found < rank:
                            sent_back = owner[at]
        return [np.array([s for s in symbols[a:b] if s >= 0], "<i4").tobytes() for a, b in spans]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens one after the other; Arrow joins them without a number per byte."""
        joined = self.token_bytes.take(pa.array(ids)).buffers()[2]
        return np.frombuffer(joined or b"", np.uint8)


_loaded: dict[tuple[str, str], tuple] = {}


def _worker(ranks_path: str, pattern: str):
    """Vocabulary, pattern and remembered words of this Python worker."""
    key = (ranks_path, pattern)
    if key not in _loaded:
        _loaded[key] = (Replay(load_ranks(ranks_path)), regex.compile(pattern), {})
    return _loaded[key]


def encode_batch(texts: Iterable[str], ranks_path: str, pattern: str) -> tuple[Replay, np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and the number of ids of each text."""
    replay, split, known = _worker(ranks_path, pattern)
    documents = [split.findall(t) for t in texts]
    if len(known) > REMEMBERED:
        known.clear()
    new = list({w for words in documents for w in words if w not in known})
    known.update(zip(new, replay.encode_words([w.encode() for w in new])))
    parts = [b"".join([known[w] for w in words]) for words in documents]
    counts = np.array([len(p) // 4 for p in parts], np.int64)
    return replay, np.frombuffer(b"".join(parts), np.int32), counts


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, ids`` (array of int) ``, decoded`` (the bytes that the ids stand for).

    Whole texts are encoded, special tokens' names as ordinary text. Null text counts as empty and has no ids; a null id
    stays null; rows that repeat give equal rows; an empty table gives an empty result; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TOGETHER):
            replay, ids, counts = encode_batch(strings(batch["text"]).to_pylist(), ranks_path, pattern)
            bytes_each = replay.token_lengths[ids]
            ends = np.concatenate(([0], np.cumsum(counts)))
            byte_ends = np.concatenate(([0], np.cumsum(bytes_each)))[ends]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(byte_ends.astype(np.int32)), pa.py_buffer(replay.decode(ids))]),
                ],
                ["id", "ids", "decoded"],
            )

    bound_batches(df.sparkSession)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(work, "id long, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids and decoded bytes as digests: ``id, n_tokens, ids_sha256, decoded_sha256``."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
