"""Streams on dense hand-made rows: late data, state across batches, TTL edges, timers and restarts."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.test_visits import DAY, HOUR, loop_alert, loop_daily, loop_new_flag, loop_sessions
from tidewater import schemas
from tidewater.operators import windows
from tidewater.sinks.files import append_stream
from tidewater.sinks.keyed import KeyedTable
from tidewater.sources import lines as src
from tidewater.streaming import joins, state
from tidewater.streaming import windows as stream_windows
from tidewater.streaming.run import run_complete, run_to_end, stream_table

READING = "key string, sec int, val int, seq bigint"
VISIT = "mid string, sid string, is_new string, ts bigint, seq bigint"


def files(spark, path, schema, *batches):
    """One file per batch, read one file at a time in the order written."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{path}/{i:03d}")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return reader.parquet(str(path))


def test_late_rows_are_dropped(spark, tmp_path):
    """With a delay of 2 s, a row behind the watermark of an earlier batch does not reach its window.

    Spark filters late rows by the watermark that held one batch before, hence the batch in between.
    """
    stream = files(
        spark,
        tmp_path,
        READING,
        [("a", 1, 7, 0), ("a", 30, 7, 1)],
        [("a", 31, 7, 2)],
        [("a", 29, 7, 3), ("a", 2, 7, 4)],
        [("a", 100, 7, 5)],
        [("a", 101, 7, 6)],
    )
    timed = stream.withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds")
    counts = windows.sliding_count(timed, "10 seconds", "10 seconds")
    got = rows(run_to_end(counts.select(F.unix_seconds("window.start").alias("start"), "cnt"), "late"))
    assert got == [(0, 1), (20, 1), (30, 2)]


def test_heaps_hold_no_more_than_the_best():
    """Any order of arrival gives the values of a sort; null wins ties."""
    rng = random.Random(6)
    rows_ = [(w, rng.choice([None, *range(9)]), rng.randint(1, 5)) for w in range(3) for _ in range(40)]
    for n in (1, 2, 5):
        for window, heap in stream_windows._best(iter(rows_), n).items():
            own = sorted(((-c, v is not None, v or 0) for w, v, c in rows_ if w == window))[:n]
            got = [(-c, (v := stream_windows._value(x)) is not None, v or 0) for c, x in sorted(heap, reverse=True)]
            assert got == own


def test_top_values_of_closed_windows(spark, tmp_path):
    batch = [("k", 1, v, i) for i, v in enumerate([7, 7, 3, 3, 5, 5, 5, 1])]
    stream = files(spark, tmp_path, READING, batch, [("k", 1000, 0, 99)])
    timed = stream.withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds")
    got = rows(run_to_end(stream_windows.top_per_window(windows.sliding_count(timed)), "top"))
    assert got == [
        ("1970-01-01 00:00:05", 1, 5, 3), ("1970-01-01 00:00:05", 2, 3, 2),
        ("1970-01-01 00:00:10", 1, 5, 3), ("1970-01-01 00:00:10", 2, 3, 2),
    ]


def in_batches(records, order, size):
    ordered = sorted(records, key=order)
    out = [ordered[i : i + size] for i in range(0, len(ordered), size)]
    for batch in out:
        random.Random(1).shuffle(batch)
    return out


def test_alert_state_spans_batches(spark, tmp_path):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), rnd.randrange(200), rnd.randrange(60), i) for i in range(120)]
    stream = files(spark, tmp_path, READING, *in_batches(data, lambda r: (r[1], r[3]), 40))
    assert rows(run_to_end(state.jump_alert(stream, 10), "alert")) == loop_alert(data, 10)


@pytest.fixture(scope="module")
def visit_rows():
    rnd = random.Random(11)
    out = []
    for seq in range(150):
        mid = rnd.choice(["hot", "hot", "a", "b"])
        out.append((mid, f"{mid}-{rnd.randrange(2)}", rnd.choice("01"), rnd.randrange(3 * DAY // 1000) * 1000, seq))
    return out


def test_visit_flags_span_batches(spark, tmp_path, visit_rows):
    batches = in_batches(visit_rows, lambda r: (r[3], r[4]), 50)
    stream = files(spark, tmp_path, VISIT, *batches)
    fixed = run_to_end(state.repair_new_flag(stream), "new")
    assert {r.seq: r.is_new for r in fixed.collect()} == loop_new_flag(visit_rows)
    daily = run_to_end(state.daily_visitor_flag(stream), "uv")
    assert {r.seq: r.uv for r in daily.collect()} == loop_daily(visit_rows)
    sessions = run_to_end(state.session_flag(stream, HOUR), "sv")
    assert {r.seq: r.sv for r in sessions.collect()} == loop_sessions(visit_rows, HOUR)


def state_rows(df, tmp_path):
    """Rows in the state after each micro-batch."""
    query = (
        df.writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "state-check"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_state_is_forgotten_and_flags_stay(spark, tmp_path, visit_rows):
    """With a watermark, 50 sessions and readings of the first batches leave the state, and flags are as without."""
    many = [(f"m{i}", f"s{i}", "1", 1000 + i, i) for i in range(50)]
    late = [[("z", "z", "1", 5 * DAY + i * DAY, 100 + i)] for i in range(3)]
    schema = VISIT
    stream = files(spark, tmp_path / "v", schema, many, *late)
    timed = stream.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "5 seconds")
    for flagged in (state.session_flag(timed, HOUR, et="et"), state.daily_visitor_flag(timed, et="et")):
        held = state_rows(flagged, tmp_path / flagged.columns[-1])
        assert max(held) >= 50 and held[-1] < 10
    readings = [(f"k{i}", 1, 0, i) for i in range(50)]
    stream = files(spark, tmp_path / "r", READING, readings, [("z", 1000, 0, 90)], [("z", 2000, 0, 91)], [("z", 3000, 0, 92)])
    timed = stream.withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds")
    held = state_rows(state.jump_alert(timed, 10, et="et"), tmp_path / "a")
    assert max(held) >= 50 and held[-1] < 10

    stream = files(spark, tmp_path / "p", VISIT, *in_batches(visit_rows, lambda r: (r[3], r[4]), 50))
    timed = stream.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "1 day")
    daily = run_to_end(state.daily_visitor_flag(timed, et="et"), "uv-timed")
    assert {r.seq: r.uv for r in daily.collect()} == loop_daily(visit_rows)
    sessions = run_to_end(state.session_flag(timed, HOUR, et="et"), "sv-timed")
    assert {r.seq: r.sv for r in sessions.collect()} == loop_sessions(visit_rows, HOUR)


def test_timer_fires_once_per_registration(spark, tmp_path):
    """A timer fires when the watermark passes it; registering twice is one timer, a passed one fires again."""
    stream = files(
        spark,
        tmp_path,
        "key string, sec int",
        [("a", 1), ("a", 2), ("b", 3)],
        [("c", 20)],
        [("d", 22)],
        [("a", 23)],
    )
    timed = stream.withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds")
    got = rows(run_to_end(state.timer_fire(timed.select("key", "et"), 5000), "timer"))
    assert got == [("a", 5000), ("a", 5000), ("b", 5000), ("c", 5000), ("d", 5000)]


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    """State and output of a stopped query continue; no row is lost or repeated."""
    source, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        return run_to_end(state.jump_alert(stream_table(spark, source, READING), 10), "restart", ck, out)

    spark.createDataFrame([("a", 1, 0, 0)], READING).write.parquet(source)
    assert rows(run()) == []
    spark.createDataFrame([("a", 2, 50, 1)], READING).write.mode("append").parquet(source)
    assert rows(run()) == [("a", 2, 0, 50)]
    assert rows(run()) == [("a", 2, 0, 50)]


def test_append_sink_restart(spark, tmp_path):
    source, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(2):
        spark.createDataFrame([("a", i, 0, i)], READING).write.mode("append").parquet(source)
        append_stream(stream_table(spark, source, READING), out, ck).awaitTermination()
    append_stream(stream_table(spark, source, READING), out, ck).awaitTermination()
    assert [r.sec for r in spark.read.parquet(out).orderBy("sec").collect()] == [0, 1]


def test_word_count_is_complete(spark, tmp_path):
    stream = files(spark, tmp_path, "value string", [("one two two",)], [("two",)])
    assert rows(run_complete(stream_windows.word_count(stream), "words")) == [("one", 1), ("two", 3)]


def test_keyed_table(spark, tmp_path):
    """The greatest time wins whatever the batch, a repeated batch changes nothing."""
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",))
    schema = "id string, v string, ts bigint"

    def batch(i, *records):
        table.write_batch(spark.createDataFrame(list(records), schema), i)

    batch(0, ("a", "old", 1), ("a", "new", 5), ("b", "x", 1))
    batch(1, ("a", "late", 3), ("b", "y", 1), ("c", "z", 9))
    want = [("a", "new", 5), ("b", "y", 1), ("c", "z", 9)]
    assert rows(table.read()) == want
    batch(1, ("a", "late", 3), ("b", "y", 1), ("c", "z", 9))
    assert rows(table.read()) == want
    batch(2, ("c", "gone on", 10))
    assert rows(table.read()) == [("a", "new", 5), ("b", "y", 1), ("c", "gone on", 10)]


def test_keyed_table_stream_restart(spark, tmp_path):
    source, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    schema = "id string, v string, ts bigint"
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",))
    for i in range(3):
        spark.createDataFrame([("a", str(i), i), (str(i), "x", i)], schema).write.mode("append").parquet(source)
        table.stream(stream_table(spark, source, schema), ck).awaitTermination()
    assert rows(table.read()) == [("0", "x", 0), ("1", "x", 1), ("2", "x", 2), ("a", "2", 2)]


def test_fact_stream_has_a_watermark(spark, tmp_path):
    """A derived fact read with a delay drops rows behind the watermark of an earlier batch."""
    text = [['{"id":"a","ts":1}', '{"id":"a","ts":100}', "broken"], ['{"id":"a","ts":101}'], ['{"id":"a","ts":2}'], ['{"id":"z","ts":500}'], ['{"id":"z","ts":501}']]
    stream = files(spark, tmp_path, "value string", *[[(line,) for line in batch] for batch in text])
    facts = src.facts(stream, T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.LongType())]), delay="3 seconds")
    counts = facts.groupBy(F.window("et", "10 seconds")).count().select(F.unix_seconds("window.start").alias("s"), "count")
    assert rows(run_to_end(counts, "facts")) == [(0, 1), (100, 2)]


def test_outer_row_appears_after_the_watermark(spark, tmp_path):
    """Lines with and without activity and coupon, in the bound and outside it."""

    def one(name, schema, records, far):
        path = tmp_path / name
        spark.createDataFrame(records, schema).coalesce(1).write.parquet(f"{path}/0")
        spark.createDataFrame([far], schema).coalesce(1).write.parquet(f"{path}/1")
        return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(path))

    detail = (
        "id string, order_id string, sku_id string, sku_name string, create_time string, sku_num string, split_total_amount string,"
        " split_activity_amount string, split_coupon_amount string, split_original_amount string, ts bigint"
    )

    def line(i, order, ts):
        return (i, order, "s", "n", "2024-01-01 00:00:00", "1", "1", "0", "0", "1", ts)

    far = 4_000_000
    details = one("d", detail, [line("1", "o", 100), line("2", "o", 100), line("3", "none", 100)], line("end", "x", far))
    orders = one("o", "user_id string, province_id string, oi_id string, oi_ts bigint", [("u", "p", "o", 105)], ("u", "p", "y", far))
    activities = one(
        "a",
        "activity_id string, activity_rule_id string, act_detail string, act_ts bigint",
        [("act", "r", "1", 100), ("late", "r", "2", 150)],
        ("e", "e", "e", far),
    )
    coupons = one("c", "coupon_id string, cou_detail string, cou_ts bigint", [("cou", "2", 95)], ("e", "e", far))
    got = run_to_end(joins.trade_order_detail(details, orders, activities, coupons), "detail")
    assert rows(got.select("id", "user_id", "activity_id", "coupon_id")) == [("1", "u", "act", None), ("2", "u", None, "cou")]


def test_interval_join_bounds(spark, tmp_path):
    """Five seconds and thirty minutes are inside, four seconds and thirty minutes one second are not."""
    details = [tuple([f"d{gap}", f"o{gap}"] + ["x"] * 14 + [10_000 - gap]) for gap in (4, 5, 1800, 1801)]
    d = files(spark, tmp_path / "d", schemas.ORDER_DETAIL, details)
    payments = [("t", "1", f"o{gap}", 10_000) for gap in (4, 5, 1800, 1801)]
    p = files(spark, tmp_path / "p", "callback_time string, payment_type_code string, pi_order string, pi_ts bigint", payments)
    dic = spark.createDataFrame([("1", ("card",))], schemas.DICTIONARY)
    got = run_to_end(joins.order_pay_success(d, p, dic, delay="1 hour"), "pay")
    assert rows(got.select("order_detail_id", "payment_type_name", "ts")) == [("d1800", "card", 10_000), ("d5", "card", 10_000)]


def test_idle_input_holds_back_only_when_waited_for(spark, tmp_path):
    """Of two joined-up inputs one stops early; the other's windows close only if the idle one is not waited for."""

    def counts(name):
        busy = files(spark, tmp_path / name / "busy", READING, [("a", 1, 0, 0)], [("a", 100, 0, 1)], [("a", 101, 0, 2)])
        idle = files(spark, tmp_path / name / "idle", READING, [("a", 2, 0, 0)])
        timed = [d.withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds") for d in (busy, idle)]
        both = timed[0].unionByName(timed[1]).groupBy(F.window("et", "10 seconds")).count()
        return both.select(F.unix_seconds("window.start").alias("s"), "count")

    assert rows(run_to_end(counts("wait"), "wait")) == []
    assert rows(run_to_end(counts("go"), "go", wait_for_idle=False)) == [(0, 2)]


def test_equal_times_follow_the_log_position(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), ("ts", "seq"))
    schema = "id string, v string, ts bigint, seq bigint"
    table.write_batch(spark.createDataFrame([("a", "second", 1, 2), ("a", "first", 1, 1)], schema), 0)
    table.write_batch(spark.createDataFrame([("a", "zeroth", 1, 0)], schema), 1)
    assert rows(table.read()) == [("a", "second", 1, 2)]


class CountingHandle:
    """State of one key in memory, with the number of calls that would go to the store."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


def test_flags_take_plain_rows_and_few_state_calls():
    made = Row("sid", "ts", "seq")
    day = state.DAY_MS
    handle, flags = CountingHandle(), state.SessionStart(100, True)
    flags.init(handle)
    got = list(flags.handleInputRows(("s",), iter([made("s", 250, 3), made("s", 0, 1), made("s", 99, 2)]), None))
    assert [(r.ts, r.seq, r.sv) for r in got] == [(0, 1, 1), (99, 2, 0), (250, 3, 1)]
    assert handle.calls == 3 and handle.value == (250,) and handle.timers == [350]
    assert [r.sv for r in flags.handleInputRows(("s",), iter([made("s", 349, 4)]), None)] == [0] and handle.calls == 4

    handle, flags = CountingHandle(), state.DailyVisitor(True)
    flags.init(handle)
    got = list(flags.handleInputRows(("m",), iter([made("s", day, 2), made("s", 5, 1), made("s", day + 1, 3)]), None))
    assert [r.uv for r in got] == [1, 1, 0] and handle.value == ("1970-01-02",) and handle.timers == [2 * day] and handle.calls == 3
    assert [r.uv for r in flags.handleInputRows(("m",), iter([made("s", day + 2, 4)]), None)] == [0] and handle.calls == 4
