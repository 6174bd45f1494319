"""Idle inputs: a silent one stops holding the watermark after its time-out, a slow one does not."""

import time

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import windows
from tidewater.session import settings
from tidewater.streaming.idle import Beats

SCHEMA = "key string, sec int, val int"


def put(spark, path, *made):
    spark.createDataFrame(list(made), SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def read(spark, path):
    path.mkdir(exist_ok=True)
    return spark.readStream.schema(SCHEMA).parquet(str(path)).withColumn("et", F.timestamp_seconds("sec"))


def closed(spark, tmp_path, now, silent_timeout, script):
    """Windows that are closed after each step of a script of rows per input; ``now`` is a clock that steps move on."""
    beats = Beats(spark, f"idle-{tmp_path.name}", lambda: now[0])
    left, right = tmp_path / "l", tmp_path / "r"
    counts = [
        windows.sliding_count(beats.input(n, read(spark, p), "et", "0 seconds", t), "10 seconds", "10 seconds")
        for n, p, t in (("left", left, 1000.0), ("right", right, silent_timeout))
    ]
    both = counts[0].unionByName(counts[1]).select(F.unix_seconds("window.start").alias("start"), "val", "cnt")
    seen = []
    with settings(spark, spark__sql__streaming__multipleWatermarkPolicy="min"):
        query = (
            both.writeStream.queryName(beats.query_name).format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
        )
        try:
            for seconds, a, b in script:
                now[0] += seconds
                for path, made in ((left, a), (right, b)):
                    if made:
                        put(spark, path, *made)
                for _ in range(3):  # the listener hears of a batch a little later, and its beat is a batch of its own
                    query.processAllAvailable()
                    time.sleep(1.2)
                seen.append({r[0] for r in rows(spark.read.schema(both.schema).parquet(str(tmp_path / "out")))})
        finally:
            query.stop()
            beats.stop()
    return seen


def test_a_silent_input_is_left_behind(spark, tmp_path):
    script = [(0, [("a", 1, 5)], [("b", 2, 6)]), (60, [("a", 25, 5)], []), (70, [("a", 45, 5)], []), (1, [("a", 65, 5)], [])]
    seen = closed(spark, tmp_path, [0.0], 120.0, script)
    assert seen[1] == set()  # 60 s of silence hold all windows
    assert {0, 20} <= seen[3]


def test_a_slow_input_holds_the_watermark(spark, tmp_path):
    script = [(0, [("a", 1, 5)], [("b", 2, 6)]), (100, [("a", 25, 5)], [("b", 3, 6)]), (100, [("a", 45, 5)], [("b", 4, 6)]), (100, [("a", 65, 5)], [("b", 5, 6)])]
    seen = closed(spark, tmp_path, [0.0], 120.0, script)
    assert seen[-1] == set()
