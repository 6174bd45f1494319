"""Whole files as rows: many small files packed into one split by size, none ever cut, empty ones included.

A file is one value of at most 2 GiB; a task reads its pack file by file and hands on a few megabytes at a time, so a
pack does not have to fit into memory, but its largest file does. The driver lists names and sizes, no contents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, content binary"
BATCH_BYTES, LARGEST = 16 << 20, (1 << 31) - 1


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Pack(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def packed(sizes: list[tuple[str, int]], limit: int, each: int) -> list[list[str]]:
    """Files in packs of at most ``limit`` bytes, each file counting ``each`` bytes more; a larger file is a pack of its own."""
    packs: list[list[str]] = []
    held: list[str] = []
    size = 0
    for name, n in sorted(sizes, key=lambda f: (-f[1], f[0])):
        if held and size + n + each > limit:
            packs.append(held)
            held, size = [], 0
        held.append(name)
        size += n + each
    return packs + [held] if held else packs


class WholeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.limit, self.each = int(options.get("packbytes", 128 << 20)), int(options.get("opencost", 1 << 20))

    def partitions(self) -> list[Pack]:
        fs, base = _open(self.path)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        files = [(f.path.removeprefix(base).lstrip("/"), f.size) for f in found if f.is_file]
        files = [(n, s) for n, s in files if not any(p[0] in "._" for p in n.split("/"))]
        for name, size in files:
            if size > LARGEST:
                raise ValueError(f"{name} holds more than 2 GiB")
        return [Pack(p) for p in packed(files, self.limit, self.each)] or [Pack([])]

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        fs, base = _open(self.path)
        names: list[str] = []
        contents: list[bytes] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
            names.clear()
            contents.clear()
            return made

        size = 0
        for name in partition.files:
            with fs.open_input_file(f"{base}/{name}") as source:
                contents.append(source.read())
            names.append(name)
            size += len(contents[-1])
            if size >= BATCH_BYTES:
                yield batch()
                size = 0
        if names:
            yield batch()


class WholeFiles(DataSource):
    """Format ``wholefiles``: one row ``path, content`` per file under ``path``, the path being relative to it."""

    @classmethod
    def name(cls) -> str:
        return "wholefiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WholeReader:
        return WholeReader({k.lower(): v for k, v in self.options.items()})


def read_packed_files(spark: SparkSession, path: str, pack_bytes: int = 128 << 20) -> DataFrame:
    """One row ``path, content`` per file, hidden files left out; an empty file is an empty value."""
    spark.dataSource.register(WholeFiles)
    return spark.read.format("wholefiles").options(path=path, packBytes=str(pack_bytes)).load()


def write_whole_files(rows: DataFrame, path: str) -> int:
    """Write each row ``path, content`` as a file under ``path``; a repeated run replaces its files. Null content is empty.

    Two rows of one path are an error of the caller: one of them stays.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(path)
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                folder = f"{base}/{name}".rsplit("/", 1)[0]
                fs.create_dir(folder, recursive=True)
                temporary = f"{folder}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(temporary, compression=None) as out:
                    out.write(content or b"")
                fs.move(temporary, f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    counted = rows.selectExpr("path", "cast(content AS binary) AS content").mapInArrow(work, "n long")
    return counted.agg({"n": "sum"}).first()[0] or 0
