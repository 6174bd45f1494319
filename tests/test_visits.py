"""Batch forms of keyed state against plain loops over the sorted rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import rows
from tidewater.operators import visits, windows

HOUR = 3_600_000
DAY = 24 * HOUR


def day(ms):
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)).date()


def make_visits(spark, records):
    """records: (mid, sid, is_new, ts, seq)"""
    data = [
        ({"mid": m, "sid": s, "vc": "v", "ch": "c", "ar": "a", "is_new": n}, {"during_time": "10"}, ts, seq)
        for m, s, n, ts, seq in records
    ]
    return spark.createDataFrame(
        data,
        "common struct<mid:string,sid:string,vc:string,ch:string,ar:string,is_new:string>, page map<string,string>, ts bigint, seq bigint",
    )


def random_visits(seed, n=600, span=4 * DAY):
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        mid = "hot" if rnd.random() < 0.4 else f"m{rnd.randrange(15)}"
        ts = rnd.randrange(span // 1000) * 1000 if rnd.random() < 0.9 else 5 * HOUR
        out.append((mid, f"{mid}-s{rnd.randrange(2)}", rnd.choice("01"), ts, seq))
    return out


def by_key(records, at):
    groups = {}
    for r in sorted(records, key=lambda r: (r[3], r[4])):
        groups.setdefault(r[at], []).append(r)
    return groups


def loop_new_flag(records):
    out = {}
    for group in by_key(records, 0).values():
        first = None
        for _, _, new, ts, seq in group:
            if first is None:
                first = day(ts) if new == "1" else day(ts) - timedelta(days=1)
            out[seq] = "0" if new == "1" and day(ts) != first else new
    return out


def loop_daily(records):
    out = {}
    for group in by_key(records, 0).values():
        last = None
        for _, _, _, ts, seq in group:
            out[seq] = int(day(ts) != last)
            last = day(ts)
    return out


def loop_sessions(records, ttl):
    out = {}
    for group in by_key(records, 1).values():
        opened = None
        for _, _, _, ts, seq in group:
            out[seq] = int(opened is None or ts >= opened + ttl)
            opened = ts if out[seq] else opened
    return out


@pytest.mark.parametrize("seed", range(3))
def test_flags_match_loops(spark, seed):
    records = random_visits(seed)
    log = make_visits(spark, records)
    flat = visits.flat_visits(log)
    fixed = {r.seq: r.is_new for r in visits.repair_new_flag(log).select("seq", "common.is_new").collect()}
    assert fixed == loop_new_flag(records)
    assert {r.seq: r.uv for r in visits.daily_visitor_flag(flat).collect()} == loop_daily(records)
    assert {r.seq: r.sv for r in visits.session_flag(flat, HOUR).collect()} == loop_sessions(records, HOUR)
    assert len(visits.first_visits(flat).collect()) == sum(loop_daily(records).values())


def test_session_ttl_is_not_extended_and_ends_exactly(spark):
    """Half-hour visits open a session every hour, not once; an hour to the millisecond opens one, less does not."""
    records = [("m", "s", "0", i * HOUR // 2, i) for i in range(6)]
    records += [("m", "edge", "0", 0, 10), ("m", "edge", "0", HOUR - 1, 11), ("m", "edge", "0", HOUR, 12)]
    flags = {r.seq: r.sv for r in visits.session_flag(visits.flat_visits(make_visits(spark, records)), HOUR).collect()}
    assert flags == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 10: 1, 11: 0, 12: 1}


def test_session_fold_across_arrow_batches(spark):
    """The last opener is carried from one Arrow batch of a task to the next."""
    records = [("m", f"s{i % 3}", "0", i * 1_700_000, i) for i in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        flags = {r.seq: r.sv for r in visits.session_flag(visits.flat_visits(make_visits(spark, records)), HOUR).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert flags == loop_sessions(records, HOUR)


def loop_alert(readings, ttl, threshold=10):
    out, last = [], {}
    for key, sec, val, _ in sorted(readings, key=lambda r: (r[1], r[3])):
        if key in last and sec - last[key][0] < ttl and abs(last[key][1] - val) > threshold:
            out.append((key, sec, last[key][1], val))
        last[key] = (sec, val)
    return sorted(out, key=repr)


READING = "key string, sec int, val int, seq bigint"


@pytest.mark.parametrize("seed", range(3))
def test_alert_matches_loop(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", "hot", "hot"]), rnd.randrange(900), rnd.randrange(60), i) for i in range(400)]
    got = rows(visits.jump_alert(spark.createDataFrame(data, READING), 10))
    assert got == loop_alert(data, 10)


def test_alert_edges(spark):
    """Ten seconds is too old, nine is not, in the same stretch or the next; a difference of ten is no alert."""
    data = [("old", 5, 0, 0), ("old", 15, 50, 1), ("young", 5, 0, 2), ("young", 14, 50, 3), ("near", 11, 0, 4), ("near", 12, 10, 5)]
    assert rows(visits.jump_alert(spark.createDataFrame(data, READING), 10)) == [("young", 14, 0, 50)]


def test_traffic_window_sums_the_flags(spark):
    records = random_visits(7)
    flat = visits.flat_visits(make_visits(spark, records))
    got = {}
    for r in windows.traffic_window(flat, "5 seconds").collect():
        got[(r.stt, r.is_new)] = (r.uv_count, r.sv_count, r.pv_count, r.duration_sum)
    uv, sv, want = loop_daily(records), loop_sessions(records, HOUR), {}
    for _, _, new, ts, seq in records:
        start = datetime(1970, 1, 1) + timedelta(milliseconds=ts // 5000 * 5000)
        key = (start.strftime("%Y-%m-%d %H:%M:%S"), new)
        a, b, c, d = want.get(key, (0, 0, 0, 0))
        want[key] = (a + uv[seq], b + sv[seq], c + 1, d + 10)
    assert got == want


def test_traffic_without_time_on_page(spark):
    log = spark.createDataFrame(
        [({"mid": "m", "sid": "s", "vc": "v", "ch": "c", "ar": "a", "is_new": "1"}, {}, 0, 0)], make_visits(spark, []).schema
    )
    row = windows.traffic_window(visits.flat_visits(log)).first()
    assert (row.stt, row.edt, row.cur_date, row.duration_sum, row.pv_count) == (
        "1970-01-01 00:00:00", "1970-01-01 00:00:05", "19700101", 0, 1,
    )


def test_top_values_break_ties_by_value(spark):
    data = [("k", 1, v, i) for i, v in enumerate([7, 7, 3, 3, 5])]
    top = windows.top_per_window(windows.sliding_count(spark.createDataFrame(data, READING)))
    assert [tuple(r) for r in top.orderBy("window_end", "rnk").collect()] == [
        ("1970-01-01 00:00:05", 1, 3, 2), ("1970-01-01 00:00:05", 2, 7, 2),
        ("1970-01-01 00:00:10", 1, 3, 2), ("1970-01-01 00:00:10", 2, 7, 2),
    ]


def test_keyword_window(spark):
    pages = spark.createDataFrame(
        [
            ({"last_page_id": "search", "item_type": "keyword", "item": "red, red (shoe)"}, 4_999),
            ({"last_page_id": "home", "item_type": "keyword", "item": "red"}, 5_000),
            ({"last_page_id": "cart", "item_type": "keyword", "item": "red"}, 0),
            ({"last_page_id": "home", "item_type": "sku", "item": "red"}, 0),
            ({"last_page_id": "home", "item_type": "keyword"}, 0),
        ],
        "page map<string,string>, ts bigint",
    )
    got = rows(windows.keyword_window(windows.search_terms(pages)).select("stt", "edt", "cur_date", "keyword", "keyword_count"))
    first, second = "1970-01-01 00:00:00", "1970-01-01 00:00:05"
    assert got == [
        (first, second, "1970-01-01", "red", 2),
        (first, second, "1970-01-01", "shoe", 1),
        (second, "1970-01-01 00:00:10", "1970-01-01", "red", 1),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_sessions_of_a_busy_sid_are_chained_over_chunks(spark, seed):
    """One sid over many chunks, dense, sparse and with long gaps, read in small Arrow batches."""
    rnd = random.Random(seed)
    at, records = rnd.randrange(10 * DAY), []
    for seq in range(1500):
        at += rnd.choice([0, 1, 60_000, 700_000, 1_900_000, HOUR, 5 * HOUR if rnd.random() < 0.1 else 30_000])
        records.append(("m", "busy" if rnd.random() < 0.9 else f"s{rnd.randrange(5)}", "0", at, seq))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        flags = {r.seq: r.sv for r in visits.session_flag(visits.flat_visits(make_visits(spark, records)), HOUR).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert flags == loop_sessions(records, HOUR)


def test_alert_within_one_second(spark):
    """All readings of a key in one second follow one another in arrival order."""
    data = [("a", 5, 0, 0), ("a", 5, 50, 1), ("a", 5, 45, 2), ("a", 6, 0, 3), ("b", 5, 9, 4)]
    assert rows(visits.jump_alert(spark.createDataFrame(data, READING), 10)) == [("a", 5, 0, 50), ("a", 6, 45, 0)]


def test_null_device_is_a_key_like_others(spark):
    """The first visit of a day is flagged for NULL too, in the flag and in a join with a summary."""
    flat = visits.flat_visits(make_visits(spark, [(None, None, "1", 1000, 1), (None, None, "1", 2000, 2), ("m", "s", "1", 1000, 3)]))
    assert sorted((r.seq, r.uv) for r in visits.daily_visitor_flag(flat).collect()) == [(1, 1), (2, 0), (3, 1)]
