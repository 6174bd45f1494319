"""A two-phase stream sink over many targets.

Each row names its target. Tasks write parts of bounded size under temporary names and report them; the commit of an
epoch gives them their names and then writes the epoch's label, a list of its parts. Readers take the parts that labels
name, so an epoch is seen whole or not at all. An epoch that fails is aborted: its parts are removed. An epoch that is
repeated after its label was written is a no-op, as its label stands.

A value is one line, JSON or plain text, which any loader of the targets can take in by part; null is an empty line.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

PART_BYTES = 64 << 20


class Parts(WriterCommitMessage):
    """What a task has written: ``target, temporary, rows, bytes`` of each part."""

    def __init__(self, parts: list[tuple[str, str, int, int]]):
        self.parts = parts


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _folder(target: str | None) -> str:
    """A target as a folder name; null has one of its own."""
    return "target=" + ("__HIVE_DEFAULT_PARTITION__" if target is None else quote(target, safe=""))


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.limit = options["path"], int(options.get("partbytes", PART_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        fs, base = _open(self.path)
        folder = f"{base}/_temporary"
        fs.create_dir(folder, recursive=True)
        # a name that no other attempt of the task has
        label = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        held: dict[str | None, tuple] = {}
        done: list[tuple[str | None, str, int, int]] = []

        def close(target) -> None:
            out, name, rows, size = held.pop(target)
            out.close()
            done.append((target, name, rows, size))

        for batch in iterator:
            for target, value in zip(batch["target"].to_pylist(), batch["value"].to_pylist()):
                if target not in held:
                    if len(held) >= 64:  # many targets: the one that was opened first is a part of its own
                        close(next(iter(held)))
                    name = f"{folder}/{label}-{len(done) + len(held):05d}"
                    held[target] = (fs.open_output_stream(name), name, 0, 0)
                out, name, rows, size = held[target]
                line = (value or "").encode() + b"\n"
                if line.find(b"\n") + 1 < len(line):
                    raise ValueError("a value holds a line end; write it as JSON")
                out.write(line)
                held[target] = (out, name, rows + 1, size + len(line))
                if size + len(line) >= self.limit:
                    close(target)
        for target in list(held):
            close(target)
        return Parts(done)

    def commit(self, messages: list[Parts | None], batchId: int) -> None:
        """Names first, the label last; a commit that was cut short is done again from the start of its epoch."""
        fs, base = _open(self.path)
        label = f"{base}/_epochs/{batchId:012d}.json"
        parts = [p for m in messages if m for p in m.parts]
        if fs.get_file_info(label).type != pafs.FileType.NotFound:
            self._remove(fs, parts)
            return
        named = []
        for number, (target, temporary, rows, size) in enumerate(sorted(parts, key=lambda p: (p[0] is not None, p[0] or "", p[1]))):
            folder = f"{base}/{_folder(target)}"
            fs.create_dir(folder, recursive=True)
            name = f"{folder}/epoch-{batchId:012d}-{number:05d}-{temporary.rsplit('-', 2)[1]}.txt"
            fs.move(temporary, name)
            named.append({"target": target, "file": name.removeprefix(f"{base}/"), "rows": rows, "bytes": size})
        fs.create_dir(f"{base}/_epochs", recursive=True)
        unfinished = f"{base}/_epochs/{uuid.uuid4().hex}.part"
        with fs.open_output_stream(unfinished) as out:
            out.write(json.dumps(named).encode())
        fs.move(unfinished, label)

    def abort(self, messages: list[Parts | None], batchId: int) -> None:
        fs, _ = _open(self.path)
        self._remove(fs, [p for m in messages if m for p in m.parts])

    @staticmethod
    def _remove(fs: pafs.FileSystem, parts: list[tuple]) -> None:
        for _, temporary, _, _ in parts:
            if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
                fs.delete_file(temporary)


class EpochSink(DataSource):
    """Format ``epochs``: rows ``target, value`` into parts per target and epoch under ``path``."""

    @classmethod
    def name(cls) -> str:
        return "epochs"

    def schema(self) -> str:
        return "target string, value string"

    def streamWriter(self, schema, overwrite: bool) -> EpochWriter:
        return EpochWriter({k.lower(): v for k, v in self.options.items()})


def write_epochs(rows: DataFrame, path: str, checkpoint: str, part_bytes: int = PART_BYTES, interval: str | None = None) -> StreamingQuery:
    """Stream ``target, value`` rows into their targets, each epoch whole or not at all."""
    rows.sparkSession.dataSource.register(EpochSink)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    stream = rows.select(F.col("target").cast("string"), F.col("value").cast("string")).writeStream.format("epochs")
    return stream.options(path=path, partBytes=str(part_bytes), checkpointLocation=checkpoint).trigger(**trigger).start()


def committed(path: str) -> list[dict]:
    """The parts of all epochs that have a label: ``epoch, target, file, rows, bytes``."""
    fs, base = _open(path)
    found = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(f"{base}/_epochs", allow_not_found=True)), key=lambda f: f.base_name):
        if re.fullmatch(r"\d+\.json", info.base_name):
            with fs.open_input_stream(info.path) as source:
                found += [{"epoch": int(info.base_name[:-5]), **part} for part in json.loads(source.read())]
    return found


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """``target, value`` of the committed parts; what has no label is not there."""
    files = [f"{path.rstrip('/')}/{part['file']}" for part in committed(path)]
    if not files:
        return spark.createDataFrame([], "target string, value string")
    lines = spark.read.text(files).select("value", F.regexp_extract(F.col("_metadata.file_path"), "/target=([^/]*)/[^/]*$", 1).alias("_folder"))
    # the folder is escaped once by its name and once as part of a path
    target = F.url_decode(F.url_decode(F.replace("_folder", F.lit("+"), F.lit("%2B"))))
    return lines.select(F.when(F.col("_folder") != "__HIVE_DEFAULT_PARTITION__", target).alias("target"), "value")
