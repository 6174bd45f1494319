"""Static range asymmetric numeral system over token ids, in NumPy.

One frequency table, scaled to a power of two, serves all blocks. A block interleaves many lanes: token i belongs to
lane i mod lanes, and all lanes take a step at once. States have 64 bits and are refilled by 32-bit words. At every
``CHECKPOINT`` steps a block stores all states and the place in its words, so that decoding may begin there; the decoder
runs all checkpoints of a block side by side.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE = 20
LOW = np.uint64(1 << 31)
CHECKPOINT = 512
LANES = 1024

_HEAD = struct.Struct("<4sIQQIII")  # mark, lanes, tokens, words, documents, checkpoints, crc32 of all that follows
_W, _K, _SLOT = np.uint64(32), np.uint64(SCALE), np.uint64((1 << SCALE) - 1)


class Table:
    """Frequencies of a vocabulary scaled to 2^SCALE; every token that occurs keeps at least one slot."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(frequencies)[:-1])).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        counts = np.asarray(counts, np.int64)
        if not counts.any():
            counts = np.ones_like(counts)
        size = 1 << SCALE
        scaled = np.where(counts > 0, np.maximum(1, counts * (size / counts.sum())).astype(np.int64), 0)
        rest = size - int(scaled.sum())
        order = np.argsort(-scaled, kind="stable")
        if rest > 0:
            scaled[order[0]] += rest
        for at in order:  # take what is too much from the most frequent
            if rest >= 0:
                break
            less = min(int(scaled[at]) - 1, max(1, int(scaled[at]) // 8), -rest) if scaled[at] > 1 else 0
            scaled[at] -= less
            rest += less
        if rest < 0:
            raise ValueError("more different tokens than slots")
        return cls(scaled)

    @property
    def slots(self) -> np.ndarray:
        """Token of every slot."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies.astype(np.int64))
        return self._slots

    def to_bytes(self) -> bytes:
        body = self.frequencies.astype("<u4").tobytes()
        return struct.pack("<I", zlib.crc32(body)) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        if zlib.crc32(data[4:]) != struct.unpack("<I", data[:4])[0]:
            raise ValueError("damaged frequency table")
        return cls(np.frombuffer(data, "<u4", offset=4))


def lanes_for(tokens: int) -> int:
    """A power of two that leaves some steps to each lane."""
    return min(LANES, 1 << max(0, (tokens // 64).bit_length() - 1)) if tokens else 1


def encode_block(table: Table, ids: np.ndarray, documents: list[tuple[int | None, int]]) -> bytes:
    """Bytes of one block: head, document ids and lengths, checkpoints, words."""
    n, lanes = len(ids), lanes_for(len(ids))
    steps = -(-n // lanes)
    frequencies, starts = table.frequencies[ids], table.starts[ids]
    if n and not frequencies.all():
        raise ValueError("a token outside the frequency table")
    limit = frequencies << np.uint64(63 - SCALE)
    state = np.full(lanes, LOW, np.uint64)
    words, marks = [], []
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[: b - a]
        f = frequencies[a:b]
        full = x >= limit[a:b]
        words.append(x[full].astype(np.uint32))
        x = np.where(full, x >> _W, x)
        quotient = x // f
        state[: b - a] = (quotient << _K) + (x - quotient * f) + starts[a:b]
        if step % CHECKPOINT == 0:
            marks.append(state.copy())
    words.reverse()
    marks.reverse()
    sizes = np.array([len(w) for w in words], np.int64)
    places = np.concatenate(([0], np.cumsum(sizes)))[:-1][::CHECKPOINT] if steps else np.empty(0, np.int64)
    stream = np.concatenate(words) if words else np.empty(0, np.uint32)
    body = b"".join(
        [
            np.array([d is not None for d, _ in documents], np.uint8).tobytes(),
            np.array([d or 0 for d, _ in documents], "<i8").tobytes(),
            np.array([k for _, k in documents], "<i8").tobytes(),
            places.astype("<i8").tobytes(),
            np.concatenate(marks).astype("<u8").tobytes() if marks else b"",
            stream.astype("<u4").tobytes(),
        ]
    )
    return _HEAD.pack(b"TWR1", lanes, n, len(stream), len(documents), len(marks), zlib.crc32(body)) + body


class Block:
    """A block as read; ``ids`` decodes all or a range of its tokens."""

    def __init__(self, data: bytes, table: Table):
        mark, self.lanes, self.tokens, words, documents, checkpoints, crc = _HEAD.unpack_from(data)
        if mark != b"TWR1" or zlib.crc32(memoryview(data)[_HEAD.size :]) != crc:
            raise ValueError("damaged block")
        at = _HEAD.size
        parts = []
        for kind, count in (("u1", documents), ("<i8", documents), ("<i8", documents), ("<i8", checkpoints), ("<u8", checkpoints * self.lanes), ("<u4", words)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        present, ids, self.lengths, self.places, states, self.words = parts
        self.document_ids = [int(d) if p else None for p, d in zip(present, ids)]
        self.states = states.reshape(checkpoints, self.lanes) if checkpoints else states.reshape(0, 1)
        self.table = table

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Tokens from ``start`` to ``end``, beginning at the last checkpoint before ``start``."""
        end = self.tokens if end is None else end
        per = CHECKPOINT * self.lanes
        first, last = start // per, -(-end // per)
        if end <= start:
            return np.empty(0, np.uint32)
        state = self.states[first:last].astype(np.uint64)
        place = self.places[first:last].astype(np.int64)
        out = np.empty((last - first, CHECKPOINT, self.lanes), np.uint32)
        table, words = self.table, np.concatenate([self.words, np.zeros(1, np.uint32)])
        begin = (first + np.arange(last - first)) * per
        for step in range(CHECKPOINT):
            left = self.tokens - (begin + step * self.lanes)  # tokens from this step on, per checkpoint
            if (left <= 0).all():
                break
            slot = state & _SLOT
            token = table.slots[slot.astype(np.int64)]
            out[:, step] = token
            state = table.frequencies[token] * (state >> _K) + slot - table.starts[token]
            low = state < LOW
            if left[-1] < self.lanes:  # the last step of a block has fewer tokens than lanes
                low[-1, max(0, int(left[-1])) :] = False
            ranks = np.cumsum(low, axis=1)
            read = np.where(low, place[:, None] + ranks - 1, len(words) - 1)
            state = np.where(low, (state << _W) | words[read].astype(np.uint64), state)
            place = place + ranks[:, -1]
        return out.reshape(-1)[start - first * per : end - first * per]
