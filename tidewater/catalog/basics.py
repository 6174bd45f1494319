"""Operators on plain collections, scalar functions and SQL-callable functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import schemas
from tidewater.catalog.registry import query
from tidewater.catalog.sqltext import K, when
from tidewater.functions import time as t
from tidewater.functions.aggregates import Average, ValueCounts, aggregate
from tidewater.functions.values import average, register_prefix
from tidewater.operators import basics
from tidewater.sources.files import in_partitions

QTY = "CAST(l_quantity AS INTEGER)"


def _numbers(spark, sf):
    rows = fx.table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("num"))


def _pairs(spark, sf):
    return basics.to_pairs(_numbers(spark, sf), F.col("num") % 2, F.col("num"))


@query("src_memory", f"SELECT {QTY} AS num, count(*) AS n FROM lineitem GROUP BY 1")
def src_memory(spark, sf):
    return in_partitions(_numbers(spark, sf).select("num"), 4).groupBy("num").agg(F.count("*").alias("n"))


@query("map_double", f"SELECT l_orderkey, l_linenumber, {QTY} * 2 AS num FROM lineitem")
def map_double(spark, sf):
    return basics.doubled(_numbers(spark, sf).select("l_orderkey", "l_linenumber", "num"), "num")


@query("map_values", f"SELECT {QTY} % 2 AS k, {QTY} * 2 AS v FROM lineitem")
def map_values(spark, sf):
    return basics.doubled(_pairs(spark, sf), "v")


@query("to_pairs", f"SELECT {QTY} % 2 AS k, {QTY} AS v FROM lineitem")
def to_pairs(spark, sf):
    return _pairs(spark, sf)


@query("filter_odd", f"SELECT l_orderkey, {QTY} AS num FROM lineitem WHERE {QTY} % 2 = 1")
def filter_odd(spark, sf):
    return basics.odd(_numbers(spark, sf).select("l_orderkey", "num"), "num")


WORDS = "SELECT doc_id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents"


@query(
    "flat_map_words",
    f"""
SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS n_chars, min(word) AS first_word, max(word) AS last_word
FROM ({WORDS}) GROUP BY doc_id
""",
)
def flat_map_words(spark, sf):
    docs = fx.spread(spark, sf, "documents", "doc_id")
    words = docs.select("doc_id", F.explode(basics.words(F.col("text"))).alias("word"))
    return words.groupBy("doc_id").agg(
        F.count("*").alias("n_words"),
        F.sum(F.length("word")).alias("n_chars"),
        F.min("word").alias("first_word"),
        F.max("word").alias("last_word"),
    )


@query("distinct_words", f"SELECT DISTINCT word FROM ({WORDS})")
def distinct_words(spark, sf):
    docs = fx.spread(spark, sf, "documents", "doc_id")
    return basics.flat_map_words(docs, "text").distinct()


@query("distinct_sorted", "SELECT DISTINCT url FROM pages ORDER BY url")
def distinct_sorted(spark, sf):
    return basics.distinct_sorted(fx.table(spark, sf, "pages").select("url"))


DEALT = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)"


@query(
    "group_collect",
    f"""
SELECT k, CASE WHEN pages > 1 THEN {DEALT} % pages ELSE 0 END AS page, array_to_string(list_sort(list(v)), ',') AS items
FROM (
  SELECT {K} % 2 AS k, {K} AS v, event_id, CAST(ceil(count(*) OVER (PARTITION BY {K} % 2) / 1000.0) AS BIGINT) AS pages FROM events
) GROUP BY 1, 2
""",
)
def group_collect(spark, sf):
    rows = fx.events(spark, sf)
    pages = basics.group_values(rows, F.col("k") % 2, F.col("k"), F.col("event_id"), 1000)
    return pages.select("k", "page", F.array_join("items", ",").alias("items"))


@query(
    "group_by_key",
    f"""
SELECT k, CASE WHEN pages > 1 THEN {DEALT} % pages ELSE 0 END AS page, array_to_string(list_sort(list(v)), ',') AS items
FROM (
  SELECT event_type AS k, user_id AS v, event_id, CAST(ceil(count(*) OVER (PARTITION BY event_type) / 1000.0) AS BIGINT) AS pages FROM events
) GROUP BY 1, 2
""",
)
def group_by_key(spark, sf):
    rows = fx.events(spark, sf)
    pages = basics.group_values(rows, F.col("event_type"), F.col("user_id"), F.col("event_id"), 1000)
    return pages.select("k", "page", F.array_join("items", ",").alias("items"))


@query("reduce_by_key", f"SELECT {QTY} % 2 AS k, CAST(sum({QTY}) AS BIGINT) AS v FROM lineitem GROUP BY 1")
def reduce_by_key(spark, sf):
    return basics.reduce_sum(_pairs(spark, sf))


@query("count_by_key", f"SELECT {QTY} % 2 AS k, count(*) AS n FROM lineitem GROUP BY 1")
def count_by_key(spark, sf):
    return basics.count_by_key(_pairs(spark, sf))


@query("count_all", f"SELECT count(*) AS n FROM ({WORDS})")
def count_all(spark, sf):
    docs = fx.spread(spark, sf, "documents", "doc_id")
    return basics.count_all(basics.flat_map_words(docs, "text"))


@query("sort_desc", f"SELECT {QTY} AS num, l_orderkey, l_partkey FROM lineitem ORDER BY num DESC, l_orderkey, l_partkey")
def sort_desc(spark, sf):
    rows = _numbers(spark, sf).select("num", "l_orderkey", "l_partkey")
    return basics.sort_desc(rows, "num", ties=("l_orderkey", "l_partkey"))


@query("sort_last_char", "SELECT p_partkey, p_name FROM part ORDER BY right(p_name, 1), p_name, p_partkey")
def sort_last_char(spark, sf):
    return basics.sort_last_char(fx.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ties=("p_partkey",))


@query("sort_by_key", f"SELECT {QTY} % 2 AS k, {QTY} AS v FROM lineitem ORDER BY k, v")
def sort_by_key(spark, sf):
    rows = _numbers(spark, sf).select((F.col("num") % 2).alias("k"), F.col("num").alias("v"), "l_orderkey", "l_linenumber")
    return basics.sort_by_key(rows, ("l_orderkey", "l_linenumber")).select("k", "v")


@query("take_n", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 3")
def take_n(spark, sf):
    return basics.take(fx.table(spark, sf, "part").select("p_partkey", "p_name"), 3, "p_partkey")


@query("sql_filter", "SELECT c_custkey AS age, c_name AS name FROM customer WHERE c_custkey > 20")
def sql_filter(spark, sf):
    return basics.sql_filter(fx.users(spark, sf), "users", "age > 20")


@query("enforce_schema", "SELECT c_custkey AS age, c_name AS name FROM customer")
def enforce_schema(spark, sf):
    raw = fx.table(spark, sf, "customer")
    return basics.enforce_schema(
        raw.select("c_mktsegment", F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("age")), schemas.USER
    )


@query(
    "flow_record",
    f"""
SELECT CAST(l_linenumber AS BIGINT) AS up, CAST({QTY} AS BIGINT) AS down, CAST(l_linenumber + {QTY} AS BIGINT) AS sum,
  concat_ws(chr(9), l_linenumber, {QTY}, l_linenumber + {QTY}) AS line
FROM lineitem
""",
)
def flow_record(spark, sf):
    rows = _numbers(spark, sf).select(F.col("l_linenumber").cast("bigint").alias("up"), F.col("num").cast("bigint").alias("down"))
    return basics.flow_record(rows)


@query("udaf_avg", "SELECT c_mktsegment AS segment, CAST(sum(c_custkey) AS DOUBLE) / count(*) AS avg_age FROM customer GROUP BY 1")
def udaf_avg(spark, sf):
    rows = fx.table(spark, sf, "customer")
    return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(average(F.col("c_custkey")).alias("avg_age"))


@query("udf_prefix", "SELECT c_custkey AS age, 'name: ' || c_name AS name FROM customer")
def udf_prefix(spark, sf):
    register_prefix(spark)
    fx.users(spark, sf).createOrReplaceTempView("users")
    return spark.sql("SELECT age, prefix_name(name) AS name FROM users")


@query("date_id", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_id FROM orders")
def date_id(spark, sf):
    rows = fx.table(spark, sf, "orders")
    made = F.date_format(F.col("o_orderdate").cast("timestamp"), t.DATE_TIME)
    return rows.select("o_orderkey", t.date_id(made).alias("date_id"))


@query(
    "epoch_to_ts",
    f"SELECT event_id, {when('ts')} AS from_seconds, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS from_millis FROM events",
)
def epoch_to_ts(spark, sf):
    rows = fx.events(spark, sf)
    return rows.select(
        "event_id",
        F.date_format(t.et_from_seconds(F.unix_seconds("et")), t.DATE_TIME).alias("from_seconds"),
        F.date_format(t.et_from_millis(F.unix_millis("et")), "yyyy-MM-dd HH:mm:ss.SSS").alias("from_millis"),
    )


@query("datetime_to_ms", "SELECT o_orderkey, epoch_ms(o_orderdate) - 28800000 AS ms FROM orders")
def datetime_to_ms(spark, sf):
    rows = fx.table(spark, sf, "orders")
    made = F.date_format(F.col("o_orderdate").cast("timestamp"), t.DATE_TIME)
    return rows.select("o_orderkey", t.datetime_to_ms(made).alias("ms"))


@query(
    "ms_to_text",
    f"""
SELECT event_id, strftime(l, '%Y-%m-%d') AS day, {when('l')} AS moment, strftime(l, '%Y%m%d') AS compact
FROM (SELECT event_id, ts + INTERVAL 8 HOUR AS l FROM events)
""",
)
def ms_to_text(spark, sf):
    rows = fx.events(spark, sf).select("event_id", F.unix_millis("et").alias("ms"))
    ms = F.col("ms")
    return rows.select(
        "event_id",
        t.ms_to_text(ms, t.DATE, "+08:00").alias("day"),
        t.ms_to_text(ms, t.DATE_TIME, "+08:00").alias("moment"),
        t.ms_to_text(ms, t.DATE_COMPACT, "+08:00").alias("compact"),
    )


@query(
    "date_compare",
    """
SELECT l_orderkey, l_linenumber, CAST(sign(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INTEGER) AS later,
  epoch_ms(date_trunc('day', l_shipdate)) - 28800000 AS ship_ms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
)
def date_compare(spark, sf):
    line, order = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")

    def day(c):
        return F.date_format(F.col(c).cast("timestamp"), t.DATE)

    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        t.compare_dates(day("l_shipdate"), day("o_orderdate")).alias("later"),
        t.date_to_ms(day("l_shipdate")).alias("ship_ms"),
    )


@query("user_average", f"SELECT event_type, avg({K}) AS mean FROM events GROUP BY event_type")
def user_average(spark, sf):
    """A user's own average: reduced per task, merged after the shuffle."""
    return aggregate(fx.events(spark, sf), ["event_type"], "k", Average(), "mean")


@query(
    "user_top_values",
    f"""
WITH counted AS (SELECT event_type, {K} AS value, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, CAST(value AS BIGINT) AS value, n FROM counted
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, value) <= 3
""",
)
def user_top_values(spark, sf):
    """An accumulator of counts, merged and cut to its top values."""
    found = aggregate(fx.events(spark, sf), ["event_type"], "k", ValueCounts(3), "top")
    return found.select("event_type", F.inline("top").alias("value", "n"))
