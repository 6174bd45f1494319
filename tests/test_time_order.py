"""Logs staged for a stream join come in the order of their time, so that later steps are not late."""

from pathlib import Path

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater import fixtures as fx
from tidewater.catalog import streams
from tidewater.operators import facts
from tidewater.streaming import joins
from tidewater.streaming.run import run_to_end


def test_steps_are_not_late_and_state_goes(spark, sf, monkeypatch):
    """Many steps give the rows of the batch join, and the join does not keep the rows of steps long past."""
    monkeypatch.setattr(streams, "ROWS_A_STEP", 2_000)
    log = fx.change_log(spark, sf, *streams.ORDER_TABLES).localCheckpoint()
    details = streams._in_order(spark, "details", facts.trade_order_detail(log, streams.DB), "ts")
    cancelled = streams._in_order(spark, "cancelled", facts.cancelled_rows(log, streams.DB), "oc_ts")
    got = run_to_end(joins.order_cancel(details, cancelled), "order-cancel")
    assert rows(got) == rows(facts.order_cancel(facts.trade_order_detail(log, streams.DB), log, streams.DB))


def test_order_of_steps(spark, tmp_path):
    """Every row comes once, a second is never cut, and a step holds no second of an earlier one."""
    some = spark.range(1000).select(F.when(F.col("id") % 50 > 0, (F.col("id") * 7919) % 100).alias("ts"), "id")
    seen = []

    def note(batch, number):
        seen.append([tuple(r) for r in batch.collect()])

    stream = streams._in_order(spark, "some", some, "ts", {"ts": 10_000}, step=100)
    stream.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start().awaitTermination()
    assert sorted(sum(seen, []), key=repr) == sorted([*map(tuple, some.collect()), (10_000, None)], key=repr)
    times = [[t for t, _ in step if t is not None] for step in seen if step]
    assert len(times) > 5 and all(max(a) < min(b) for a, b in zip(times, times[1:]))


def test_sides_share_their_steps(spark, monkeypatch):
    """Every step brings the same seconds of all sides, its rows are not shuffled, and what was staged before is let go."""
    def shuffled(self, *dealt):
        raise AssertionError("a step is shuffled")

    monkeypatch.setattr(type(spark.range(1)), "repartition", shuffled)
    made, new_dir = {}, streams.new_dir
    monkeypatch.setattr(streams, "new_dir", lambda session, label: made.setdefault(label, new_dir(session, label)))
    long = spark.range(1000).select((F.col("id") % 100).alias("ts"), "id")
    short = spark.range(50).select((F.col("id") * 2).alias("at"), F.col("id").alias("other"))
    streams._in_step(spark, [("long", long, "ts", None), ("short", short, "at", {"at": 10_000})], step=100)
    spans = []
    for label, column in (("long", "ts"), ("short", "at")):
        folders = sorted(Path(made[label].removeprefix("file:")).iterdir())
        spans.append([[r[0] for r in spark.read.parquet(str(f)).select(column).collect()] for f in folders])
    assert len(spans[0]) > 5 and len(spans[1]) == len(spans[0]) + 1 and spans[1][-1] == [10_000]
    assert all(a and b and max(b) <= max(a) for a, b in zip(*spans))
    assert sorted(sum(spans[1], [])) == [*range(0, 100, 2), 10_000]
    assert spark.read.parquet(made["long-whole"]).count() == 0 == spark.read.parquet(made["short-whole"]).count()
