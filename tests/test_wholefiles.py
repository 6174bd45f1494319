"""Packed whole files: none cut, empty ones there, packs by size."""

from pathlib import Path

import pytest

from tests.conftest import rows
from tidewater.sources import wholefiles
from tidewater.sources.wholefiles import packed, read_packed_files, write_whole_files


def test_packs_by_size():
    sizes = [("a", 5), ("b", 0), ("c", 40), ("d", 7), ("e", 7), ("f", 0)]
    packs = packed(sizes, 16, 1)
    assert packs == [["c"], ["d", "e"], ["a", "b", "f"]]
    assert packed([], 16, 1) == [] and sorted(sum(packs, [])) == sorted(n for n, _ in sizes)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wholefiles, "BATCH_BYTES", 10)
    made = [("empty", b""), ("deep/er/x.bin", bytes(range(256)) * 40), ("none", None), ("ü n.txt", "日本\n".encode()), *[(f"s/{i:03d}", b"%d" % i) for i in range(60)]]
    df = spark.createDataFrame(made, "path string, content binary")
    for _ in range(2):
        assert write_whole_files(df, str(tmp_path)) == len(made)
    Path(tmp_path, "_SUCCESS").write_text("hidden")
    Path(tmp_path, ".part").write_text("hidden")
    got = read_packed_files(spark, str(tmp_path), 1 << 24)
    assert rows(got.selectExpr("path", "cast(content as binary) c")) == sorted(((p, bytearray(c or b"")) for p, c in made), key=repr)
    assert got.rdd.getNumPartitions() < len(made) / 4


def test_no_files(spark, tmp_path):
    assert read_packed_files(spark, str(tmp_path)).count() == 0
    assert write_whole_files(spark.createDataFrame([], "path string, content binary"), str(tmp_path)) == 0


def test_a_file_beyond_a_value_is_an_error(spark, tmp_path, monkeypatch):
    Path(tmp_path, "big").write_bytes(b"12345")
    monkeypatch.setattr(wholefiles, "LARGEST", 4)
    with pytest.raises(ValueError, match="2 GiB"):
        wholefiles.WholeReader({"path": str(tmp_path)}).partitions()
