"""Windowed streams: word count and top values per window."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import DATE_TIME
from tidewater.operators.basics import flat_map_words


def word_count(lines: DataFrame) -> DataFrame:
    """Running count of each word; write it in complete mode."""
    return flat_map_words(lines).groupBy("word").agg(F.count("*").alias("cnt"))


def _best(rows: Iterator[tuple], n: int) -> dict:
    """The ``n`` best ``(count, value)`` of each window, in a heap that never holds more; ties go to null, then to the smaller value."""
    best: dict = {}
    for window, val, cnt in rows:
        heap = best.setdefault(window, [])
        item = (cnt, float("inf") if val is None else -val)
        if len(heap) < n:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)
    return best


def _value(negative: float | int) -> int | None:
    return None if negative == float("inf") else -negative


def top_per_window(counts: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` most frequent values per closed window, ties by value.

    Analytic windows do not run on streams. All counts of a window come out in the micro-batch in which it closes, so
    each task keeps the ``n`` best of every window in a heap, and a grouping of what is left, ``n`` rows a task at most,
    orders them. ``val`` is a number.
    """
    flat = counts.select(F.col("window.end").alias("end"), F.col("val").cast("long").alias("val"), F.col("cnt").cast("long").alias("cnt"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _best((row for b in batches for row in zip(b["end"].cast(pa.int64()).to_pylist(), b["val"].to_pylist(), b["cnt"].to_pylist())), n)
        rows = [(end, _value(negative), cnt) for end, heap in best.items() for cnt, negative in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], ["micros", "val", "cnt"])

    def whole(group: pa.Table) -> pa.Table:
        heap = next(iter(_best(zip(*[group[c].to_pylist() for c in ("micros", "val", "cnt")]), n).values()))
        ranked = sorted(heap, reverse=True)
        names = ["micros", "rnk", "val", "cnt"]
        columns = ([group["micros"][0].as_py()] * len(ranked), range(1, len(ranked) + 1), [_value(v) for _, v in ranked], [c for c, _ in ranked])
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names)

    parts = flat.mapInArrow(part, "micros long, val long, cnt long")
    rows = parts.groupBy("micros").applyInArrow(whole, "micros long, rnk int, val long, cnt long")
    return rows.select(F.date_format(F.timestamp_micros("micros"), DATE_TIME).alias("window_end"), "rnk", F.col("val").cast(counts.schema["val"].dataType).alias("val"), "cnt")
