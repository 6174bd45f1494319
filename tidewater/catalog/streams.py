"""Streaming forms, run to the end of their input; each must give the rows of its batch form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.catalog.facts import DETAIL_SQL, ORDER_TABLES, PAY_SQL
from tidewater.catalog.dims import dim_columns, write_step
from tidewater.catalog.logs import routed
from tidewater.catalog.registry import SQL, query
from tidewater.catalog.visits import ALERT_SQL, NEW_FLAG_SQL, SV_SQL, TOP_SQL, UV_SQL
from tidewater.operators import changes, facts, visits, windows
from tidewater.plans import warehouse
from tidewater.session import new_dir, settings
from tidewater.sinks.files import write_text
from tidewater.sinks.keyed import CellTable
from tidewater.sources.lines import read_lines
from tidewater.streaming import changelog, joins, state
from tidewater.streaming import windows as stream_windows
from tidewater.streaming.run import STAGING, run_complete, run_to_end, stream_table

DB = fx.DATABASE
HOURLY = ("1 hour", "5 seconds")
TIMER_MS = 1_705_276_800_000  # 2024-01-15, inside the time span of the events
FAR = 4102444800  # seconds of 2100-01-01, past every row, to close the last windows


def _flat(spark, sf):
    return visits.flat_visits(fx.app_log(spark, sf, stream=True)).drop("day")


def _timed(rows, seconds):
    return rows.withColumn("et", F.timestamp_seconds(seconds)).withWatermark("et", "5 seconds")


@query("is_new_fix_stream", NEW_FLAG_SQL)
def is_new_fix_stream(spark, sf):
    return run_to_end(state.repair_new_flag(_flat(spark, sf)), "new-flag").select("seq", "mid", "is_new")


@query("uv_flag_stream", UV_SQL)
def uv_flag_stream(spark, sf):
    return run_to_end(state.daily_visitor_flag(_timed(_flat(spark, sf), F.col("ts") / 1000), et="et"), "uv-flag").select("seq", "mid", "uv")


def _halves(spark, sf):
    """Visits before the middle of the month as a table, those from then on as a stream."""
    flat = visits.flat_visits(fx.app_log(spark, sf)).drop("day")
    early = flat.where(F.col("ts") < TIMER_MS)
    path = new_dir(spark, "late-visits")
    flat.where(F.col("ts") >= TIMER_MS).write.parquet(path)
    return early, stream_table(spark, path, flat.schema)


@query("is_new_fix_resumed", NEW_FLAG_SQL)
def is_new_fix_resumed(spark, sf):
    """A stream that starts in the middle of the log, from a batch snapshot of what came before."""
    early, late = _halves(spark, sf)
    known = visits.first_days(early).select("mid", F.col("first").cast("string").alias("first"))
    fixed = run_to_end(state.repair_new_flag(late, known), "resumed-flag").select("seq", "mid", "is_new")
    return visits.repair_new_flag(fx.app_log(spark, sf).where(F.col("ts") < TIMER_MS)).select("seq", "common.mid", "common.is_new").unionByName(fixed)


@query("uv_flag_resumed", UV_SQL)
def uv_flag_resumed(spark, sf):
    early, late = _halves(spark, sf)
    flagged = run_to_end(state.daily_visitor_flag(late, known=visits.last_days(early)), "resumed-uv").select("seq", "mid", "uv")
    day = F.to_date(F.timestamp_millis("ts"))
    return visits.daily_visitor_flag(early.withColumn("day", day)).select("seq", "mid", "uv").unionByName(flagged)


@query("sv_flag_stream", SV_SQL)
def sv_flag_stream(spark, sf):
    return run_to_end(state.session_flag(_timed(_flat(spark, sf), F.col("ts") / 1000), et="et"), "sv-flag").select("seq", "sid", "sv")


@query("jump_alert_stream", ALERT_SQL)
def jump_alert_stream(spark, sf):
    return run_to_end(state.jump_alert(_timed(fx.readings(spark, sf, stream=True), "sec"), ttl=3600, et="et"), "alert")


@query("timer_fire", f"SELECT DISTINCT 'u' || (user_id % 20) AS key, CAST({TIMER_MS} AS BIGINT) AS fired_at FROM events")
def timer_fire(spark, sf):
    rows = fx.events(spark, sf, stream=True).withWatermark("et", "2 seconds")
    keyed = rows.select(F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("key"), "et")
    return run_to_end(state.timer_fire(keyed, TIMER_MS), "timer")


@query("stream_word_count", "SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word")
def stream_word_count(spark, sf):
    lines = fx.stream_of(spark, sf, "part").select(F.col("p_name").alias("value"))
    return run_complete(stream_windows.word_count(lines), "word-count")


@query("window_top_n_stream", TOP_SQL)
def window_top_n_stream(spark, sf):
    staged = new_dir(spark, "readings")
    rows = fx.readings(spark, sf)
    rows.write.parquet(staged)
    spark.createDataFrame([("end", None, -1, -1)], rows.schema).withColumn("sec", F.lit(2147400000)).write.mode("append").parquet(staged)
    timed = stream_table(spark, staged, rows.schema).withColumn("et", F.timestamp_seconds("sec")).withWatermark("et", "2 seconds")
    counts = windows.sliding_count(timed.select("et", "val"), "2 hours", "1 hour")
    return run_to_end(stream_windows.top_per_window(counts), "top-n")


def _staged(spark, label, rows, close: dict | None = None):
    """Rows as files to stream, with a last row far in the future that matches nothing."""
    path = new_dir(spark, label)
    rows.write.parquet(path)
    if close:
        _closing(spark, rows.schema, close).write.mode("append").parquet(path)
    return stream_table(spark, path, rows.schema)


#: Rows of the largest staged log that one micro-batch takes, about.
ROWS_A_STEP = 2_000_000


def _in_step(spark, sides, step: int | None = None):
    """Logs as files to stream in the order of their time, so that a watermark lets go of state and drops no row.

    ``sides`` are ``(label, rows, time column, closing row or None)``. A step of the stream holds all rows of the same
    seconds of every side, so that rows meet in the step that brings them; the closing rows of ``_staged`` come last. What is
    staged on the way there is emptied as soon as it has been passed on.
    """
    with settings(spark, **STAGING):
        wholes = [new_dir(spark, f"{label}-whole") for label, _, _, _ in sides]
        for whole, (_, rows, _, _) in zip(wholes, sides):
            rows.write.parquet(whole)
        staged = [spark.read.schema(rows.schema).parquet(whole) for whole, (_, rows, _, _) in zip(wholes, sides)]
        counts = [s.count() for s in staged]
        most = counts.index(max(counts))
        steps, at = -(-counts[most] // (step or ROWS_A_STEP)), sides[most][2]
        if steps < 2:
            for s, whole, (_, _, _, close) in zip(staged, wholes, sides):
                if close:
                    _closing(spark, s.schema, close).write.mode("append").parquet(whole)
            return [stream_table(spark, whole, s.schema) for s, whole in zip(staged, wholes)]
        last = staged[most].agg(F.max(at)).first()[0]
        bounds = sorted({b for b in staged[most].stat.approxQuantile(at, [i / steps for i in range(1, steps)], 0.1 / steps) if b < last})
        paths, files = [new_dir(spark, label) for label, _, _, _ in sides], spark.sparkContext.defaultParallelism
        for s, whole, path, (label, _, time, close) in zip(staged, wholes, paths, sides):
            _steps(spark, s, whole, path, label, time, bounds, files)
            if close:
                write_step(_closing(spark, s.schema, close), f"{path}/{len(bounds) + 1:06d}", files, deal=False)
    return [stream_table(spark, p, s.schema, per_batch=files, recursiveFileLookup="true") for p, s in zip(paths, staged)]


def _steps(spark, staged, whole, path, label, at, bounds, files):
    """The steps of one side, one write after the other, as a stream takes files by the time they were written."""
    number = reduce(lambda n, b: n + (F.col(at) > b).cast("int"), bounds, F.lit(0))
    sliced = new_dir(spark, f"{label}-sliced")
    # a null time has no place in the log and goes with the first step
    staged.withColumn("_step", F.coalesce(number, F.lit(0))).write.partitionBy("_step").parquet(sliced)
    _empty(spark, whole)
    found = {r[0] for r in spark.read.parquet(sliced).select("_step").distinct().collect()}
    for i in range(len(bounds) + 1):
        one = f"{sliced}/_step={i}"
        rows = spark.read.schema(staged.schema).parquet(one) if i in found else spark.createDataFrame([], staged.schema)
        write_step(rows, f"{path}/{i:06d}", files, deal=False)
        if i in found:
            _empty(spark, one)


def _closing(spark, schema, close: dict):
    return spark.range(1).select(*[F.lit(close.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _empty(spark, path: str) -> None:
    """Let go of the files of a staged folder."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def _in_order(spark, label, rows, at: str, close: dict | None = None, step: int | None = None):
    """One log in the order of its time, see ``_in_step``."""
    return _in_step(spark, [(label, rows, at, close)], step)[0]


@query("order_pay_success_stream", PAY_SQL)
def order_pay_success_stream(spark, sf):
    log = fx.change_log(spark, sf, *ORDER_TABLES, "payment_info")
    details, payments = _in_step(
        spark, [("details", facts.trade_order_detail(log, DB), "ts", None), ("payments", facts.payment_rows(log, DB), "pi_ts", None)]
    )
    return run_to_end(joins.order_pay_success(details, payments, fx.dictionary(spark, sf)), "pay-success")


@query("trade_order_detail_stream", DETAIL_SQL)
def trade_order_detail_stream(spark, sf):
    log = fx.change_log(spark, sf, *ORDER_TABLES)
    sides = [
        ("lines", facts.order_detail_rows(log, DB), "ts", {"id": "end", "order_id": "end-of-lines", "ts": FAR}),
        ("orders", facts.order_rows(log, DB), "oi_ts", {"oi_id": "end-of-orders", "oi_ts": FAR}),
        ("activities", facts.activity_rows(log, DB), "act_ts", {"act_detail": "end-of-activities", "act_ts": FAR}),
        ("coupons", facts.coupon_rows(log, DB), "cou_ts", {"cou_detail": "end-of-coupons", "cou_ts": FAR}),
    ]
    parts = _in_step(spark, sides)
    return run_to_end(joins.trade_order_detail(*parts), "order-detail")


@query("trade_order_detail_changelog", DETAIL_SQL)
def trade_order_detail_changelog(spark, sf):
    """The join that answers at once, its corrections folded."""
    log = fx.change_log(spark, sf, *ORDER_TABLES)
    parts = [
        _staged(spark, "lines", facts.order_detail_rows(log, DB)),
        _staged(spark, "orders", facts.order_rows(log, DB)),
        _staged(spark, "activities", facts.activity_rows(log, DB)),
        _staged(spark, "coupons", facts.coupon_rows(log, DB)),
    ]
    return changelog.fold(run_to_end(changelog.trade_order_detail(*parts), "order-detail-changes"))


def _closed_log(spark, sf):
    """The application log as files to stream, with a last record far in the future to close all windows."""
    path = new_dir(spark, "app-log")
    log = fx.app_log(spark, sf)
    log.write.parquet(path)
    page = {"last_page_id": "home", "item_type": "keyword", "item": "end"}
    common = dict.fromkeys(("mid", "vc", "ch", "ar", "is_new", "sid"), "end")
    last = [(common, page, None, None, None, None, FAR * 1000, -1)]
    spark.createDataFrame(last, log.schema).write.mode("append").parquet(path)
    return stream_table(spark, path, log.schema)


@query("keyword_window_stream", SQL["keyword_window"])
def keyword_window_stream(spark, sf):
    return run_to_end(warehouse.keyword_stream(_closed_log(spark, sf), *HOURLY), "keywords")


@query("traffic_window_stream", SQL["traffic_window"])
def traffic_window_stream(spark, sf):
    return run_to_end(warehouse.traffic_stream(_closed_log(spark, sf), *HOURLY), "traffic")


@query("log_routes_stream", SQL["log_routes"])
def log_routes_stream(spark, sf):
    path = new_dir(spark, "log-lines")
    write_text(fx.app_log_lines(spark, sf), path)
    lines = read_lines(spark, "text", stream=True, path=path)
    return routed(run_to_end(warehouse.log_line_stream(lines), "log-routes"))


@query("dim_tables_stream", SQL["dim_tables"])
def dim_tables_stream(spark, sf):
    """Changes of the configured tables as a stream of files, a few per batch, into a stored cell table."""
    path = new_dir(spark, "dim-changes")
    log = fx.change_log(spark, sf, "user_info", "static")
    log.write.parquet(path)
    table = CellTable(spark, new_dir(spark, "dim-cells"))
    config = fx.dim_config(spark).withColumns({"op": F.lit("r"), "seq": F.lit(1)})
    stream = stream_table(spark, path, log.schema, per_batch=4)
    warehouse.dimension_stream(stream, lambda: config, table, new_dir(spark, "dim-checkpoint"), DB).awaitTermination()
    return dim_columns(table.read())


@query("order_cancel_stream", SQL["order_cancel"])
def order_cancel_stream(spark, sf):
    log = fx.change_log(spark, sf, *ORDER_TABLES)
    details, cancelled = _in_step(
        spark, [("details", facts.trade_order_detail(log, DB), "ts", None), ("cancelled", facts.cancelled_rows(log, DB), "oc_ts", None)]
    )
    return run_to_end(joins.order_cancel(details, cancelled), "order-cancel")


ALL_TIME = "36500 DAYS"  # the test tables ship lines years before and after their order


@query("order_refund_stream", SQL["order_refund"])
def order_refund_stream(spark, sf):
    log = fx.change_log(spark, sf, "order_info", "refund")
    refunds = _staged(spark, "refunds", facts.refund_rows(log, DB))
    orders = _staged(spark, "refunding", facts.orders_with_status(log, DB, "1005"))
    return run_to_end(joins.order_refund(refunds, orders, fx.dictionary(spark, sf), ALL_TIME), "order-refund")


@query("refund_pay_success_stream", SQL["refund_pay_success"])
def refund_pay_success_stream(spark, sf):
    log = fx.change_log(spark, sf, "order_info", "refund")
    parts = [
        _staged(spark, "refund-paid", facts.refund_paid_rows(log, DB)),
        _staged(spark, "refund-done", facts.refund_done_rows(log, DB)),
        _staged(spark, "refunded-orders", facts.orders_with_status(log, DB, "1006")),
    ]
    return run_to_end(joins.refund_pay_success(*parts, fx.dictionary(spark, sf), ALL_TIME), "refund-pay")


@query("order_refund_changelog", SQL["order_refund"])
def order_refund_changelog(spark, sf):
    """The join that needs no bound of time between a request and its order."""
    log = fx.change_log(spark, sf, "order_info", "refund")
    refunds = _staged(spark, "refunds", facts.refund_rows(log, DB))
    orders = _staged(spark, "refunding", facts.orders_with_status(log, DB, "1005"))
    return changelog.fold(run_to_end(changelog.order_refund(refunds, orders, fx.dictionary(spark, sf)), "order-refund-changes"))


@query("refund_pay_success_changelog", SQL["refund_pay_success"])
def refund_pay_success_changelog(spark, sf):
    log = fx.change_log(spark, sf, "order_info", "refund")
    parts = [
        _staged(spark, "refund-paid", facts.refund_paid_rows(log, DB)),
        _staged(spark, "refund-done", facts.refund_done_rows(log, DB)),
        _staged(spark, "refunded-orders", facts.orders_with_status(log, DB, "1006")),
    ]
    return changelog.fold(run_to_end(changelog.refund_pay_success(*parts, fx.dictionary(spark, sf)), "refund-pay-changes"))


@query("comment_info_stream", SQL["comment_info"])
def comment_info_stream(spark, sf):
    log = _staged(spark, "comments", fx.change_log(spark, sf, "comment_info"))
    return run_to_end(facts.comment_info(log, fx.dictionary(spark, sf), DB), "comment-rows")


@query("cart_add_stream", SQL["cart_add"])
def cart_add_stream(spark, sf):
    return run_to_end(changes.cart_add(_staged(spark, "carts", fx.change_log(spark, sf, "cart_info")), DB), "cart-rows")
