"""Event-time window summaries and top rows per window."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import explode_tokens, tokens
from tidewater.functions.time import DATE, DATE_COMPACT, DATE_TIME, et_from_millis, et_from_seconds
from tidewater.operators.visits import HOUR_MS, first_visits, session_starts

SEARCH_PAGES = ("search", "home")


def search_terms(pages: DataFrame) -> DataFrame:
    """Search texts of keyword pages that were reached from a search or home page."""
    page = F.col("page")
    return pages.where(
        page["last_page_id"].isin(*SEARCH_PAGES) & (page["item_type"] == "keyword") & page["item"].isNotNull()
    ).select(page["item"].alias("kw"), et_from_millis(F.col("ts")).alias("et"))


def _bounds(day: str) -> list[Column]:
    start, end = F.col("window.start"), F.col("window.end")
    return [
        F.date_format(start, DATE_TIME).alias("stt"),
        F.date_format(end, DATE_TIME).alias("edt"),
        F.date_format(start, day).alias("cur_date"),
    ]


def keyword_window(terms: DataFrame, size: str = "5 seconds", tokenizer: Callable[[Column], Column] = tokens) -> DataFrame:
    """Count of each search word per tumbling window; ``tokenizer`` may be a segmenter for text without blanks."""
    words = explode_tokens(terms, F.col("kw"), tokenizer=tokenizer).select("keyword", "et")
    counts = words.groupBy(F.window("et", size), "keyword").agg(F.count("*").alias("keyword_count"))
    return counts.select(*_bounds(DATE), "keyword", "keyword_count")


DIMENSIONS = ("vc", "ch", "ar", "is_new")
MEASURES = ("uv_count", "sv_count", "pv_count", "duration_sum")
NAMES = {"vc": "version", "ch": "channel", "ar": "region"}


def traffic_summary(rows: DataFrame, size: str) -> DataFrame:
    """Sum of the four measures per window and dimension; ``rows`` hold the measures and a time ``et``."""
    totals = rows.groupBy(F.window("et", size), *DIMENSIONS).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]
    )
    return totals.withColumnsRenamed(NAMES).select(
        *_bounds(DATE_COMPACT), "version", "channel", "region", "is_new", *MEASURES
    )


def traffic_window(visits: DataFrame, size: str = "5 seconds", session_ttl_ms: int = HOUR_MS) -> DataFrame:
    """Page views, visitors, sessions and time on page per window, version, channel, region and visitor kind.

    Each measure comes from the rows that carry it, with the others at zero, so no row is sent to the task of
    its device or session just to be flagged: only first visits and session openers are.
    """

    def part(rows: DataFrame, **measures: Column) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        return rows.select(
            et_from_millis(F.col("ts")).alias("et"), *DIMENSIONS, *[measures.get(m, zero).alias(m) for m in MEASURES]
        )

    one = F.lit(1).cast("bigint")
    narrow = visits.select("mid", "sid", *DIMENSIONS, "ts", "seq", "day")
    parts = [
        part(visits, pv_count=one, duration_sum=F.coalesce("during_time", F.lit(0)).cast("bigint")),
        part(first_visits(narrow.drop("sid")), uv_count=one),
        part(session_starts(narrow.drop("mid", "day"), session_ttl_ms), sv_count=one),
    ]
    return traffic_summary(reduce(DataFrame.unionByName, parts), size)


def sliding_count(readings: DataFrame, size: str = "10 seconds", slide: str = "5 seconds") -> DataFrame:
    """Readings per value and sliding window; ``readings`` hold ``sec, val`` or a time ``et`` and ``val``."""
    timed = readings if "et" in readings.columns else readings.withColumn("et", et_from_seconds(F.col("sec")))
    return timed.groupBy(F.window("et", size, slide), "val").agg(F.count("*").alias("cnt"))


def top_per_window(counts: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` most frequent values per window, ties by value; each map task already keeps only its best ``n``."""
    order = Window.partitionBy("window").orderBy(F.desc("cnt"), F.asc("val"))
    return (
        counts.withColumn("rnk", F.row_number().over(order))
        .where(F.col("rnk") <= n)
        .select(F.date_format("window.end", DATE_TIME).alias("window_end"), "rnk", "val", "cnt")
    )
