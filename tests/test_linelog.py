"""Lines with positions: splits at every byte, starts, admission, restarts."""

from pathlib import Path

import pytest

from tests.conftest import rows
from tidewater.sources import lines as src
from tidewater.sources.linelog import LineReader, LineStream, _Log, read_line_log

TEXT = "one\ntwo\n\nünïcode 日本\r\n" + "long " * 50 + "\nlast"


def whole(tmp_path, text=TEXT):
    Path(tmp_path, "a.log").write_bytes(text.encode())
    want, at = [], 0
    for line in text.encode().split(b"\n"):
        want.append((line.removesuffix(b"\r").decode(), "a.log", at))
        at += len(line) + 1
    return want


@pytest.mark.parametrize("split", [1, 2, 3, 5, 7, 64, 1 << 20])
def test_every_split_gives_the_same_lines(tmp_path, split):
    want = whole(tmp_path)
    log = _Log({"path": str(tmp_path), "splitbytes": split})
    got = [tuple(r.values()) for part in log.ranges({}, log.sizes(), tail=True) for b in log.lines(part) for r in b.to_pylist()]
    assert got == want


def test_batch(spark, tmp_path):
    want = whole(tmp_path)
    Path(tmp_path, "_hidden").write_text("no\n")
    Path(tmp_path, "b.log").write_text("")
    assert rows(read_line_log(spark, str(tmp_path), splitBytes="6")) == sorted(want, key=repr)
    Path(tmp_path, "empty").mkdir()
    assert read_line_log(spark, str(tmp_path / "empty")).count() == 0


def stream(tmp_path, **options):
    return LineStream({"path": str(tmp_path / "log"), "progress": str(tmp_path / "notes"), **options})


def test_admission_by_bytes(tmp_path):
    (tmp_path / "log").mkdir()
    Path(tmp_path, "log", "a").write_bytes(b"12345\n" * 10 + b"x" * 100 + b"\nopen")
    Path(tmp_path, "log", "b").write_bytes(b"12345\n" * 4)
    reader, seen, at = stream(tmp_path, bytespertrigger="13"), [], {}
    while (end := reader.latestOffset()) != at:
        seen += [(r["file"], r["pos"]) for p in reader.partitions(at, end) for b in reader.read(p) for r in b.to_pylist()]
        assert sum(end.values()) - sum(at.values()) <= 101
        at = end
    assert sorted(seen) == sorted([("a", 6 * i) for i in range(11)] + [("b", 6 * i) for i in range(4)]) and at == {"a": 161, "b": 24}


def test_a_new_reader_never_goes_back(tmp_path):
    (tmp_path / "log").mkdir()
    Path(tmp_path, "log", "a").write_bytes(b"12345\n" * 10)
    first = stream(tmp_path, bytespertrigger="12").latestOffset()
    again = stream(tmp_path, bytespertrigger="12").latestOffset()
    assert first == {"a": 12} and again == {"a": 24}


def run(spark, tmp_path, **options):
    lines = read_line_log(spark, str(tmp_path / "log"), stream=True, progress=str(tmp_path / "notes"), **options)
    query = lines.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return rows(spark.read.schema(lines.schema).parquet(str(tmp_path / "out")))


def test_restart_loses_and_repeats_nothing(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a").write_text("".join(f"a{i}\n" for i in range(50)) + "half")
    assert len(run(spark, tmp_path, bytesPerTrigger="60")) == 50
    with (log / "a").open("a") as out:
        out.write(" whole\nmore\n")
    (log / "b").write_text("b0\nb1\n")
    got = run(spark, tmp_path, bytesPerTrigger="60")
    assert len(got) == len(set(got)) == 54
    assert [r[0] for r in sorted(got, key=lambda r: (r[1], r[2]))] == [*[f"a{i}" for i in range(50)], "half whole", "more", "b0", "b1"]


def test_latest_start(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a").write_text("old\nunfin")
    assert run(spark, tmp_path, start="latest") == []
    with (log / "a").open("a") as out:
        out.write("ished\nnew\n")
    assert [r[0] for r in sorted(run(spark, tmp_path, start="latest"), key=lambda r: r[2])] == ["unfinished", "new"]


def test_positions_order_changes_of_one_second(spark, tmp_path):
    """The change log takes ``pos`` along, so two changes of a second keep the order of the log."""
    made = [f'{{"database":"d","table":"t","type":"update","data":{{"id":"1","v":"{v}"}},"old":null,"ts":5}}' for v in "abc"]
    Path(tmp_path, "log.txt").write_text("\n".join(made) + "\nno json\n")
    log = src.change_log(read_line_log(spark, str(tmp_path)))
    assert [r.data["v"] for r in sorted(log.collect(), key=lambda r: r.pos)] == ["a", "b", "c"]


def test_small_splits_share_a_task(tmp_path):
    want = whole(tmp_path)
    reader = LineReader({"path": str(tmp_path), "splitbytes": "3", "tasks": "4"})
    parts = reader.partitions()
    assert 4 <= len(parts) <= 8 < sum(len(p.parts) for p in parts)
    assert [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()] == want


def test_a_split_reads_its_own_bytes_only(tmp_path):
    Path(tmp_path, "a.log").write_bytes(b"a line of text\n" * 200_000)
    log, read = _Log({"path": str(tmp_path), "splitbytes": 200_000}), 0

    class Counted:
        def __init__(self, source):
            self.source = source

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.source.close()

        def seek(self, at):
            self.source.seek(at)

        def read(self, n):
            nonlocal read
            data = self.source.read(n)
            read += len(data)
            return data

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, path):
            return Counted(self.fs.open_input_file(path))

    ranges = log.ranges({}, log.sizes(), tail=True)
    log.fs = Files(log.fs)
    assert sum(b.num_rows for part in ranges for b in log.lines(part)) == 200_000
    assert read < 2 * 3_000_000


def test_read_as_few_tasks(spark, tmp_path):
    want = whole(tmp_path, "line\n" * 3000)
    lines = read_line_log(spark, str(tmp_path), splitBytes="10")
    assert lines.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
    assert rows(lines) == rows(spark.createDataFrame(want[:-1], lines.schema))
