"""Aggregates written by a user as zero, reduce, merge and finish, in partials before and after the shuffle.

A task reduces the values of each key to one buffer, array by array, and only buffers are shuffled. Buffers of a key
meet twice: those of some tasks in parts, then the parts. So a key that holds most of the rows is a few buffers per task,
and no task merges those of all tasks.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Keys whose buffers a task holds before it passes them on, and parts in which buffers of a key are merged first.
HELD, PARTS = 50_000, 32


class Aggregate(ABC):
    """An aggregate over values that are not null."""

    result: str  #: Spark type of ``finish``

    @abstractmethod
    def zero(self) -> Any:
        """The buffer of no values."""

    @abstractmethod
    def reduce(self, buffer: Any, values: np.ndarray) -> Any:
        """The buffer with some values more."""

    @abstractmethod
    def merge(self, a: Any, b: Any) -> Any:
        """The buffer of the values of both."""

    @abstractmethod
    def finish(self, buffer: Any) -> Any:
        """What the buffer stands for; the result for no values may be None."""


class Average(Aggregate):
    """Sum and count; whole numbers are added exactly, whatever the order."""

    result = "double"

    def zero(self):
        return (0, 0)

    def reduce(self, buffer, values):
        total = sum(map(int, values.tolist())) if values.dtype.kind in "iu" else float(values.sum())
        return (buffer[0] + total, buffer[1] + len(values))

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def finish(self, buffer):
        return buffer[0] / buffer[1] if buffer[1] else None


class ValueCounts(Aggregate):
    """How often each value occurs, the ``most`` frequent first, ties by value: the accumulator of a top list."""

    result = "array<struct<value:bigint,count:bigint>>"

    def __init__(self, most: int | None = None):
        self.most = most

    def zero(self):
        return {}

    def reduce(self, buffer, values):
        return self.merge(buffer, dict(zip(*(x.tolist() for x in np.unique(values, return_counts=True)))))

    def merge(self, a, b):
        for value, count in b.items():
            a[value] = a.get(value, 0) + count
        return a

    def finish(self, buffer):
        found = sorted(buffer.items(), key=lambda x: (-x[1], x[0]))[: self.most]
        return [{"value": v, "count": c} for v, c in found]


class Quantiles(Aggregate):
    """Quantiles from a sketch of sorted lists of ``size`` values, each level weighing twice the one below.

    A full list is halved to every second value, the first and the second in turn. A halving at weight w moves a rank by
    at most w, and n values cause at most n / (size * w) of them, so after levels 0 to h a rank is off by at most
    n * (h + 1) / size, with h = log2(n / size). Up to ``size`` values the answer is exact: the smallest value whose
    share of all is at least the quantile.
    """

    result = "array<double>"

    def __init__(self, at: tuple[float, ...], size: int = 1024):
        self.at, self.size = at, size

    def zero(self):
        return ([np.empty(0)], [0])

    def _settle(self, levels, turns):
        level = 0
        while level < len(levels):
            while len(levels[level]) > self.size:
                if level + 1 == len(levels):
                    levels.append(np.empty(0))
                    turns.append(0)
                values = np.sort(levels[level])
                odd = len(values) % 2
                kept, halved = values[:odd], values[odd:]
                levels[level], levels[level + 1] = kept, np.concatenate((levels[level + 1], halved[turns[level] % 2 :: 2]))
                turns[level] += 1
            level += 1
        return (levels, turns)

    def reduce(self, buffer, values):
        levels, turns = buffer
        values = values.astype(np.float64)
        for a in range(0, len(values), self.size):
            levels[0] = np.concatenate((levels[0], values[a : a + self.size]))
            self._settle(levels, turns)
        return buffer

    def merge(self, a, b):
        levels, turns = list(a[0]), list(a[1])
        for level, values in enumerate(b[0]):
            if level == len(levels):
                levels.append(np.empty(0))
                turns.append(0)
            levels[level] = np.concatenate((levels[level], values))
        return self._settle(levels, turns)

    def finish(self, buffer):
        values = np.concatenate(buffer[0])
        if not len(values):
            return None
        weights = np.concatenate([np.full(len(v), 1 << h, np.int64) for h, v in enumerate(buffer[0])])
        order = np.argsort(values, kind="stable")
        share = np.cumsum(weights[order]) / weights.sum()
        return [float(values[order][min(len(values) - 1, int(np.searchsorted(share, q - 1e-12)))]) for q in self.at]


def aggregate(rows: DataFrame, keys: list[str], value: str, by: Aggregate, name: str) -> DataFrame:
    """``keys`` and the aggregate of ``value`` under ``name``, one row per combination of keys, null being one like others.

    Null values take no part; keys with none but these have the result for no values. An empty table has no rows.
    """
    fields = [rows.schema[k] for k in keys]
    held = T.StructType([*fields, T.StructField("_part", T.IntegerType()), T.StructField("_buffer", T.BinaryType())])

    def table(found: dict[tuple, Any], part: int) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[] for _ in keys]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(found), pa.int32()), pa.array([pickle.dumps(b) for b in found.values()], pa.binary())], [*keys, "_part", "_buffer"])

    kinds = [to_arrow_type(f.dataType) for f in fields]

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % PARTS
        found: dict[tuple, Any] = {}
        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([(value, "list")]) if batch.num_rows else None
            if grouped is None:
                continue
            for row, values in zip(zip(*[grouped[k].to_pylist() for k in keys]), grouped[f"{value}_list"]):
                buffer = found.get(row)
                buffer = by.zero() if buffer is None else buffer
                there = values.values.drop_null()
                found[row] = by.reduce(buffer, there.to_numpy(zero_copy_only=False)) if len(there) else buffer
            if len(found) > HELD:
                yield table(found, part)
                found = {}
        if found:
            yield table(found, part)

    def merged(buffers: pa.ChunkedArray) -> Any:
        result = by.zero()
        for buffer in buffers:
            result = by.merge(result, pickle.loads(buffer.as_py()))
        return result

    def merge_part(group: pa.Table) -> pa.Table:
        return group.slice(0, 1).set_column(len(keys) + 1, "_buffer", pa.array([pickle.dumps(merged(group["_buffer"]))], pa.binary()))

    out = T.StructType([*fields, T.StructField(name, T._parse_datatype_string(by.result))])

    def finish(group: pa.Table) -> pa.Table:
        answer = pa.array([by.finish(merged(group["_buffer"]))], to_arrow_type(out[name].dataType))
        return group.slice(0, 1).select(keys).append_column(name, answer)

    partial = rows.select(*keys, F.col(value)).mapInArrow(reduce_rows, held)
    parts = partial.groupBy(*keys, "_part").applyInArrow(merge_part, held)
    return parts.groupBy(*keys).applyInArrow(finish, out)
