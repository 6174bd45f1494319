"""The two-phase sink: whole epochs, failures, repeats, many targets and small parts."""

from pathlib import Path

import pytest

from tests.conftest import rows
from tests.test_streaming import files
from tidewater.sinks.epochs import EpochWriter, committed, read_epochs, write_epochs

SCHEMA = "target string, value string"
FIRST = [("a", "1"), ("b/c d%e+", "2"), (None, "3"), ("a", None), ("ünï", "日本")]
SECOND = [("a", "4"), ("b/c d%e+", "5")]


def start(spark, tmp_path, stream, **options):
    query = write_epochs(stream, str(tmp_path / "out"), str(tmp_path / "check"), **options)
    query.awaitTermination()


def as_read(*batches):
    return sorted(((t, v or "") for b in batches for t, v in b), key=repr)


def test_epochs_and_targets(spark, tmp_path):
    stream = files(spark, tmp_path / "in", SCHEMA, FIRST, SECOND, [])
    start(spark, tmp_path, stream)
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == as_read(FIRST, SECOND)
    parts = committed(str(tmp_path / "out"))
    assert {p["target"] for p in parts if p["epoch"] == 0} == {t for t, _ in FIRST} and sum(p["rows"] for p in parts) == 7
    assert not list(Path(tmp_path, "out", "_temporary").iterdir())


def test_parts_are_bounded(spark, tmp_path):
    many = [(f"t{n % 100}", f"value {n:04d}") for n in range(2000)]
    start(spark, tmp_path, files(spark, tmp_path / "in", SCHEMA, many), part_bytes=50)
    parts = committed(str(tmp_path / "out"))
    assert max(p["bytes"] for p in parts) <= 50 + 11 and sum(p["rows"] for p in parts) == 2000
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == as_read(many)


def test_a_failed_epoch_leaves_nothing_and_a_restart_completes_it(spark, tmp_path, monkeypatch):
    """A value with a line end fails the second epoch; with it mended, the same query goes on."""
    path = tmp_path / "in"
    stream = files(spark, path, SCHEMA, FIRST, [*SECOND, ("a", "bad\nvalue")])
    with pytest.raises(Exception, match="line end"):
        start(spark, tmp_path, stream)
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == as_read(FIRST)
    assert not [p for p in Path(tmp_path, "out").rglob("epoch-000000000001-*")]
    for old in Path(path, "001").glob("part-*"):
        spark.createDataFrame(SECOND, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "mended"))
        old.write_bytes(next(Path(tmp_path, "mended").glob("part-*")).read_bytes())
        Path(path, "001", f".{old.name}.crc").unlink(missing_ok=True)
    start(spark, tmp_path, files(spark, path, SCHEMA))
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == as_read(FIRST, SECOND)


def batches(*made):
    import pyarrow as pa

    return iter([pa.RecordBatch.from_pydict({"target": [t for t, _ in made], "value": [v for _, v in made]})])


@pytest.fixture
def writer(tmp_path, monkeypatch):
    class Context:
        @staticmethod
        def get():
            return Context()

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr("tidewater.sinks.epochs.TaskContext", Context)
    return EpochWriter({"path": str(tmp_path / "out")})


def test_a_repeated_epoch_is_a_no_op(spark, tmp_path, writer):
    writer.commit([writer.write(batches(("a", "1"))), None], 0)
    writer.commit([writer.write(batches(("a", "1"), ("a", "again")))], 0)
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == [("a", "1")]
    assert not list(Path(tmp_path, "out", "_temporary").iterdir())


def test_a_commit_cut_short_is_not_seen_and_done_again(spark, tmp_path, writer, monkeypatch):
    moves = []
    real = type(writer).commit

    def failing(messages):
        import tidewater.sinks.epochs as epochs

        dumps = epochs.json.dumps
        monkeypatch.setattr(epochs.json, "dumps", lambda x: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            real(writer, messages, 5)
        monkeypatch.setattr(epochs.json, "dumps", dumps)
        moves.append(1)

    failing([writer.write(batches(("a", "1"), ("b", "2")))])
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == [] and moves
    writer.commit([writer.write(batches(("a", "1"), ("b", "2")))], 5)
    assert rows(read_epochs(spark, str(tmp_path / "out"))) == [("a", "1"), ("b", "2")]


def test_abort_removes_parts(tmp_path, writer):
    message = writer.write(batches(("a", "1")))
    writer.abort([message, None], 1)
    assert not list(Path(tmp_path, "out", "_temporary").iterdir())
