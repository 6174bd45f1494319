"""Append-only line files as a log with positions, read as a batch or a stream.

Every line has its file and its byte offset there in ``pos``, the order of the log inside a file. A stream begins at the
``earliest`` line or, with ``start`` ``latest``, at what is appended after its first start. A batch of the stream takes
at most ``bytesPerTrigger`` bytes, or one line where that is longer; what it takes is noted under ``progress`` before it
is read, so that a restarted query, which asks anew where the log ends, never gets a place behind the one it knows.
Only lines that are ended are read by a stream; a batch also reads a last line without its end.

Ranges are cut into splits of ``splitBytes``. A split owns the lines that begin in it, wherever they end, so no more of a
file is read for it than itself and one line. A task of a batch reads small splits one after the other, up to
``TASK_BYTES`` of them, as long as there are ``tasks`` tasks: a Python task costs more to start than a small split to read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "value string, file string, pos bigint"
#: Bytes read at a time at most, and where only the end of a line is wanted.
BUFFER, LINE = 4 << 20, 64 << 10
#: Bytes of the small splits that share a task at most.
TASK_BYTES = 64 << 20


class Range(InputPartition):
    def __init__(self, file: str, begin: int, a: int, b: int, tail: bool):
        self.file, self.begin, self.a, self.b, self.tail = file, begin, a, b, tail


class Ranges(InputPartition):
    def __init__(self, parts: list[Range]):
        self.parts = parts


def shared(ranges: list[Range], tasks: int) -> list[Ranges]:
    """Neighbouring ranges put together for at least ``tasks`` tasks, if there are so many, of at most ``TASK_BYTES``."""
    limit = min(TASK_BYTES, sum(r.b - r.a for r in ranges) / tasks)
    made, held = [], 0
    for part in ranges:
        size = part.b - part.a
        if not made or held + size > limit:
            made.append(Ranges([]))
            held = 0
        made[-1].parts.append(part)
        held += size
    return made


class _Log:
    def __init__(self, options: dict):
        path = options["path"]
        self.fs, self.base = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        self.split = int(options.get("splitbytes", 64 << 20))

    def sizes(self) -> dict[str, int]:
        """Files of the log by their names; hidden and unfinished ones are left out."""
        found = self.fs.get_file_info(pafs.FileSelector(self.base, recursive=True, allow_not_found=True))
        names = {f.path.removeprefix(self.base).lstrip("/"): f.size for f in found if f.is_file}
        return {n: s for n, s in sorted(names.items()) if not any(p[0] in "._" for p in n.split("/"))}

    def ended(self, file: str, begin: int, limit: int, size: int) -> int:
        """Where the last ended line before ``limit`` ends; past it if no line ends before, ``begin`` if none does."""
        with self.fs.open_input_file(f"{self.base}/{file}") as source:
            high = limit
            while high > begin:
                low = max(begin, high - BUFFER)
                source.seek(low)
                at = source.read(high - low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                high = low
            source.seek(limit)
            while limit < size:
                data = source.read(min(BUFFER, size - limit))
                at = data.find(b"\n")
                if at >= 0:
                    return limit + at + 1
                limit += len(data)
        return begin

    def ranges(self, start: dict[str, int], end: dict[str, int], tail: bool = False) -> list[Range]:
        made = []
        for file, b in sorted(end.items()):
            begin = start.get(file, 0)
            made += [Range(file, begin, a, min(b, a + self.split), tail) for a in range(begin, b, self.split)]
        return made

    def lines(self, part: Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the range."""
        with self.fs.open_input_file(f"{self.base}/{part.file}") as source:
            at = part.a
            if at > part.begin:  # a line that began before belongs to the split before
                source.seek(at - 1)
                at = self._next(source, at - 1)
            source.seek(at)
            rest, begin = b"", at
            while begin < part.b:
                # no more than what is left of the split, but for the end of a last line
                data = source.read(min(BUFFER, max(part.b - begin - len(rest), LINE)))
                if not data:
                    break
                data, rest = rest + data, b""
                ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
                starts = begin + np.concatenate(([0], ends[:-1] + 1)) if len(ends) else np.empty(0, np.int64)
                kept = int((starts < part.b).sum())
                if kept:
                    yield self._batch(part.file, [data[s - begin : e] for s, e in zip(starts[:kept].tolist(), ends[:kept].tolist())], starts[:kept])
                last = int(ends[-1]) + 1 if len(ends) else 0
                rest, begin = data[last:], begin + last
                if kept < len(ends):
                    return
            if rest and part.tail and begin < part.b:
                yield self._batch(part.file, [rest], np.array([begin]))

    @staticmethod
    def _next(source, at: int) -> int:
        while data := source.read(LINE):
            found = data.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(data)
        return at

    @staticmethod
    def _batch(file: str, lines: list[bytes], starts: np.ndarray) -> pa.RecordBatch:
        text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
        return pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array([file] * len(lines), pa.string()), pa.array(starts, pa.int64())], ["value", "file", "pos"])


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.log, self.tasks = _Log(options), int(options.get("tasks", 1))

    def partitions(self) -> list[Ranges]:
        return shared(self.log.ranges({}, self.log.sizes(), tail=True), self.tasks) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from self.log.lines(part)


class LineStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.log = _Log(options)
        self.start, self.limit = options.get("start", "earliest"), options.get("bytespertrigger")
        if self.start not in ("earliest", "latest"):
            raise ValueError("start is earliest or latest")
        if "progress" not in options:
            raise ValueError("progress names a folder that the query keeps, like its checkpoint")
        self.notes = options["progress"].removeprefix("file://")
        self.planned: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        if self.start == "earliest":
            return {}
        sizes = self.log.sizes()
        self.planned = {f: end for f, s in sizes.items() if (end := self.log.ended(f, 0, s, s))}
        self._note()
        return self.planned

    def latestOffset(self) -> dict:
        if self.planned is None:
            self.planned = self._noted()
        left = int(self.limit) if self.limit else None
        for file, size in self.log.sizes().items():
            begin = self.planned.get(file, 0)
            if size > begin and left != 0:
                until = size if left is None else min(size, begin + left)
                end = self.log.ended(file, begin, until, size)
                if end > begin:
                    self.planned[file] = end
                    left = None if left is None else max(0, left - (end - begin))
        self._note()
        return dict(self.planned)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.log.ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.log.lines(partition)

    def _noted(self) -> dict[str, int]:
        found = [f for f in self.log.fs.get_file_info(pafs.FileSelector(self.notes, allow_not_found=True)) if f.base_name.endswith(".json")]
        if not found:
            return {}
        with self.log.fs.open_input_stream(max(found, key=lambda f: f.base_name).path) as source:
            return json.loads(source.read())

    def _note(self) -> None:
        """The newest note has the greatest name; older ones go when it is there."""
        self.log.fs.create_dir(self.notes, recursive=True)
        before = [f for f in self.log.fs.get_file_info(pafs.FileSelector(self.notes)) if f.base_name.endswith(".json")]
        number = max((int(f.base_name.removesuffix(".json")) for f in before), default=-1) + 1
        temporary = f"{self.notes}/{uuid.uuid4().hex}.part"
        with self.log.fs.open_output_stream(temporary) as out:
            out.write(json.dumps(self.planned).encode())
        self.log.fs.move(temporary, f"{self.notes}/{number:012d}.json")
        for old in before:
            self.log.fs.delete_file(old.path)


class LineLog(DataSource):
    """Format ``linelog``: ``value, file, pos`` of the lines under ``path``."""

    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> LineStream:
        return LineStream({k.lower(): v for k, v in self.options.items()})


def read_line_log(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """``value, file, pos`` of a line log; a stream needs ``progress``, and takes ``start`` and ``bytesPerTrigger``."""
    spark.dataSource.register(LineLog)
    reader = spark.readStream if stream else spark.read.option("tasks", 4 * spark.sparkContext.defaultParallelism)
    return reader.format("linelog").options(path=path, **options).load()
