"""Visitor flags, traffic summary, sliding counts, top values and alerts, in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.catalog.registry import query
from tidewater.catalog.sqltext import LOG, READINGS, openers
from tidewater.functions.time import DATE_TIME
from tidewater.operators import visits, windows
from tidewater.plans import warehouse
from tidewater.session import new_dir

NEW_FLAG_SQL = f"""
WITH {LOG}, first AS (
  SELECT *, first_value(is_new) OVER w AS new0, CAST(first_value(et) OVER w AS DATE) AS day0
  FROM log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
)
SELECT seq, mid, CASE WHEN is_new = '1' AND CAST(et AS DATE) <> CASE WHEN new0 = '1' THEN day0 ELSE day0 - 1 END
  THEN '0' ELSE is_new END AS is_new
FROM first
"""


@query("is_new_fix", NEW_FLAG_SQL)
def is_new_fix(spark, sf):
    return visits.repair_new_flag(fx.app_log(spark, sf)).select("seq", "common.mid", "common.is_new")


UV_SQL = f"""
WITH {LOG}, prev AS (SELECT seq, mid, day, lag(day) OVER (PARTITION BY mid ORDER BY ts, seq) AS before FROM log)
SELECT seq, mid, CAST(CASE WHEN before IS NULL OR before <> day THEN 1 ELSE 0 END AS INTEGER) AS uv FROM prev
"""


@query("uv_flag", UV_SQL)
def uv_flag(spark, sf):
    flat = visits.flat_visits(fx.app_log(spark, sf))
    return visits.daily_visitor_flag(flat).select("seq", "mid", "uv")


SV_SQL = f"""
WITH RECURSIVE {LOG}, {openers('log')}
SELECT log.seq, log.sid, CAST(CASE WHEN opened.seq IS NULL THEN 0 ELSE 1 END AS INTEGER) AS sv
FROM log LEFT JOIN opened ON log.sid = opened.sid AND log.seq = opened.seq
"""


@query("sv_flag", SV_SQL)
def sv_flag(spark, sf):
    flat = visits.flat_visits(fx.app_log(spark, sf))
    return visits.session_flag(flat).select("seq", "sid", "sv")


def _traffic(shown: str) -> str:
    """Hourly traffic of the pages ``shown``."""
    return f"""{shown}, {openers('shown')},
flags AS (
  SELECT shown.*, date_trunc('hour', et) AS h, CASE WHEN opened.seq IS NULL THEN 0 ELSE 1 END AS sv,
    CASE WHEN lag(day) OVER (PARTITION BY mid ORDER BY shown.ts, shown.seq) = day THEN 0 ELSE 1 END AS uv
  FROM shown LEFT JOIN opened ON shown.sid = opened.sid AND shown.seq = opened.seq
)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS stt, strftime(h + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS edt,
  strftime(h, '%Y%m%d') AS cur_date, vc AS version, ch AS channel, ar AS region, is_new,
  CAST(sum(uv) AS BIGINT) AS uv_count, CAST(sum(sv) AS BIGINT) AS sv_count, count(*) AS pv_count,
  CAST(sum(during_time) AS BIGINT) AS duration_sum
FROM flags GROUP BY h, vc, ch, ar, is_new
"""


@query("traffic_window", f"WITH RECURSIVE {LOG}, " + _traffic("shown AS (SELECT * FROM log WHERE event_type <> 'signup')"))
def traffic_window(spark, sf):
    return warehouse.traffic_summary(fx.app_log(spark, sf), "1 hour")


# What the log split leaves on its page output: whole records, flags repaired over all records, no starts.
PAGES = f"""{LOG}, whole AS (SELECT * FROM log WHERE seq % 97 <> 0), devices AS (
  SELECT *, first_value(is_new) OVER w AS new0, CAST(first_value(et) OVER w AS DATE) AS day0
  FROM whole WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
), shown AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND CAST(et AS DATE) <> CASE WHEN new0 = '1' THEN day0 ELSE day0 - 1 END
    THEN '0' ELSE is_new END AS is_new)
  FROM devices WHERE event_type <> 'signup'
)"""


def _stored_pages(spark, sf, parsed=None):
    path, staging = new_dir(spark, "split-log"), new_dir(spark, "split-staging")
    warehouse.write_log(fx.app_log_lines(spark, sf), path, staging)
    return warehouse.stored_pages(spark, path, parsed)


@query("traffic_window_pages", "WITH RECURSIVE " + _traffic(PAGES))
def traffic_window_pages(spark, sf):
    """The summary as a job of its own, which reads the page output that the split has stored."""
    return warehouse.traffic_summary(_stored_pages(spark, sf, new_dir(spark, "split-pages")), "1 hour")


@query(
    "keyword_window_pages",
    f"""
WITH {PAGES}, words AS (
  SELECT date_trunc('hour', et) AS h, unnest(string_split(item, ' ')) AS keyword FROM shown
  WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL
)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS stt, strftime(h + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS edt,
  strftime(h, '%Y-%m-%d') AS cur_date, keyword, count(*) AS keyword_count
FROM words GROUP BY h, keyword
""",
)
def keyword_window_pages(spark, sf):
    return warehouse.keyword_summary(_stored_pages(spark, sf), "1 hour")


SLIDING = f"""
{READINGS}, counts AS (
  SELECT (sec // 3600) * 3600 + step AS window_end, val, count(*) AS cnt
  FROM readings, (VALUES (3600), (7200)) v(step) GROUP BY 1, 2
)"""
END = "strftime(make_timestamp(CAST(window_end AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


@query("sliding_count", f"WITH {SLIDING} SELECT {END} AS window_end, val, cnt FROM counts")
def sliding_count(spark, sf):
    counts = windows.sliding_count(fx.readings(spark, sf), "2 hours", "1 hour")
    return counts.select(F.date_format("window.end", DATE_TIME).alias("window_end"), "val", "cnt")


TOP_SQL = f"""
WITH {SLIDING}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, val) AS rnk FROM counts
)
SELECT {END} AS window_end, CAST(rnk AS INTEGER) AS rnk, val, cnt FROM ranked WHERE rnk <= 2
"""


@query("window_top_n", TOP_SQL)
def window_top_n(spark, sf):
    return windows.top_per_window(windows.sliding_count(fx.readings(spark, sf), "2 hours", "1 hour"))


ALERT_SQL = f"""
WITH {READINGS}, prev AS (
  SELECT *, lag(sec) OVER w AS prev_sec, lag(val) OVER w AS prev_val
  FROM readings WINDOW w AS (PARTITION BY key ORDER BY sec, seq)
)
SELECT key, sec, prev_val, val FROM prev WHERE sec - prev_sec < 3600 AND abs(prev_val - val) > 10
"""


@query("jump_alert", ALERT_SQL)
def jump_alert(spark, sf):
    return visits.jump_alert(fx.readings(spark, sf), ttl=3600)
