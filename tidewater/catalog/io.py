"""Sources and sinks: each query writes derived rows to the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import schemas
from tidewater.catalog.registry import SQL, query
from tidewater.catalog.sqltext import K, STATUS, seconds, text
from tidewater.session import new_dir
from tidewater.sinks import files as out
from tidewater.sinks.keyed import KeyedTable
from tidewater.sources import files
from tidewater.sources import lines as src
from tidewater.sources.linelog import read_line_log
from tidewater.sources.wholefiles import read_packed_files, write_whole_files
from tidewater.streaming.run import run_to_end, stream_table

USERS_SQL = "SELECT c_custkey AS age, c_name AS name FROM customer"
USERS_TEXT_SQL = f"SELECT {text('c_custkey')} AS age, c_name AS name FROM customer"
NAMES_SQL = "SELECT p_name AS value FROM part"


def _names(spark, sf):
    return fx.table(spark, sf, "part").select(F.col("p_name").alias("value"))


@query(
    "src_change_log",
    f"""
SELECT 'order_info' AS tbl, type, {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id,
  CASE WHEN type = 'update' THEN {STATUS} END AS order_status,
  {seconds('o_orderdate')} + CASE WHEN type = 'update' THEN 600 ELSE 0 END AS ts
FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('insert'), ('update')) v(type)
WHERE o_orderkey % 97 <> 0
""",
)
def src_change_log(spark, sf):
    path = new_dir(spark, "change-log")
    out.write_text(fx.order_log_lines(spark, sf), path)
    return _order_changes(src.change_log(src.read_lines(spark, "text", path=path)))


def _order_changes(log):
    data = F.col("data")
    return log.select(
        F.col("table").alias("tbl"),
        "type",
        data["id"].alias("id"),
        data["user_id"].alias("user_id"),
        data["order_status"].alias("order_status"),
        "ts",
    )


@query("src_line_log", SQL["src_change_log"])
def src_line_log(spark, sf):
    """The change log from a source that gives every line its position."""
    path = new_dir(spark, "line-log")
    out.write_text(fx.order_log_lines(spark, sf), path)
    log = src.change_log(read_line_log(spark, path, splitBytes="200000"))
    return _order_changes(log.where(F.col("pos") >= 0))


@query("src_line_log_stream", SQL["src_change_log"])
def src_line_log_stream(spark, sf):
    path = new_dir(spark, "line-log")
    out.write_text(fx.order_log_lines(spark, sf), path)
    lines = read_line_log(spark, path, stream=True, progress=new_dir(spark, "line-log-progress"))
    return _order_changes(src.change_log(run_to_end(lines, "line-log-rows")))


@query("src_raw_log", f"SELECT user_id || ',' || event_type || ',' || {K} AS value FROM events")
def src_raw_log(spark, sf):
    path = new_dir(spark, "raw-log")
    out.write_text(fx.events(spark, sf).select(F.concat_ws(",", "user_id", "event_type", "k").alias("value")), path)
    return src.read_raw_log(spark, "text", path=path)


@query(
    "src_line_stream",
    f"""SELECT 'u' || (user_id % 20) AS key, CAST(floor(epoch(ts)) AS INTEGER) AS sec, {K} AS val
FROM events WHERE event_id % 97 <> 0""",
)
def src_line_stream(spark, sf):
    path = new_dir(spark, "line-stream")
    out.write_text(fx.reading_lines(spark, sf), path)
    return run_to_end(src.readings(src.read_lines(spark, "text", stream=True, path=path)), "line-stream-rows")


@query("src_csv", USERS_TEXT_SQL)
def src_csv(spark, sf):
    path = new_dir(spark, "csv")
    fx.users(spark, sf).write.option("header", True).csv(path)
    return files.read_csv(spark, path)


@query("src_json", USERS_SQL)
def src_json(spark, sf):
    path = new_dir(spark, "json")
    fx.users(spark, sf).write.json(path)
    return files.read_json(spark, path)


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def src_parquet(spark, sf):
    return files.read_parquet(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("src_text", NAMES_SQL)
def src_text(spark, sf):
    path = new_dir(spark, "text")
    out.write_text(_names(spark, sf), path)
    return files.read_text(spark, path)


@query("src_compressed", "SELECT codec, p_name AS value FROM part, (VALUES ('gzip'), ('bzip2')) v(codec)")
def src_compressed(spark, sf):
    base = new_dir(spark, "compressed")
    for codec in ("gzip", "bzip2"):
        out.write_text(_names(spark, sf), f"{base}/codec={codec}", codec)
    return spark.read.option("basePath", base).text(base).select("codec", "value")


@query(
    "src_whole_file",
    "SELECT CAST(c_nationkey AS INTEGER) AS nation, CAST(sum(length(c_name) + 1) AS BIGINT) AS n_bytes FROM customer GROUP BY 1",
)
def src_whole_file(spark, sf):
    path = new_dir(spark, "whole")
    customer = fx.table(spark, sf, "customer")
    customer.select("c_name", F.col("c_nationkey").alias("nation")).write.partitionBy("nation").text(path)
    whole = files.read_whole_files(spark, path)
    nation = F.regexp_extract("path", r"nation=(\d+)", 1).cast("int")
    return whole.groupBy(nation.alias("nation")).agg(F.sum(F.octet_length("content")).cast("bigint").alias("n_bytes"))


@query(
    "src_packed_files",
    """
SELECT CAST(n_nationkey AS INTEGER) AS nation, CAST(coalesce(sum(length(c_name) + 1), 0) AS BIGINT) AS n_bytes
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9500 GROUP BY 1
""",
)
def src_packed_files(spark, sf):
    """A file per nation, empty where it has no rich customer, written whole and read in packs."""
    path = new_dir(spark, "packed")
    rich = fx.table(spark, sf, "customer").where("c_acctbal > 9500")
    names = fx.table(spark, sf, "nation").join(rich, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    text = F.array_join(F.collect_list(F.concat("c_name", F.lit("\n"))), "")
    write_whole_files(names.groupBy(F.concat(F.lit("nation-"), "n_nationkey").alias("path")).agg(text.alias("content")), path)
    whole = read_packed_files(spark, path, 1 << 21)
    nation = F.regexp_extract("path", r"nation-(\d+)", 1).cast("int")
    return whole.select(nation.alias("nation"), F.octet_length("content").cast("bigint").alias("n_bytes"))


@query("sink_csv_gzip", USERS_TEXT_SQL)
def sink_csv_gzip(spark, sf):
    path = new_dir(spark, "csv-gzip")
    out.write_csv_gzip(fx.users(spark, sf), path)
    return files.read_csv(spark, path)


@query("sink_json", USERS_SQL)
def sink_json(spark, sf):
    path = new_dir(spark, "json")
    out.write_json(fx.users(spark, sf), path)
    return files.read_json(spark, path, schemas.USER)


@query("sink_parquet", USERS_SQL)
def sink_parquet(spark, sf):
    path = new_dir(spark, "parquet")
    out.write_parquet(fx.users(spark, sf), path)
    return files.read_parquet(spark, path)


@query("sink_text", NAMES_SQL)
def sink_text(spark, sf):
    path = new_dir(spark, "text")
    out.write_text(_names(spark, sf), path)
    return files.read_text(spark, path)


@query("sink_compressed", NAMES_SQL)
def sink_compressed(spark, sf):
    path = new_dir(spark, "text-gzip")
    out.write_text(_names(spark, sf), path, "gzip")
    return files.read_text(spark, path)


@query("sink_routed", "SELECT CASE WHEN contains(url, '/fr/') THEN 'main' ELSE 'other' END AS route, url AS value FROM (SELECT DISTINCT url FROM pages)")
def sink_routed(spark, sf):
    path = new_dir(spark, "routed")
    out.write_routed(fx.table(spark, sf, "pages").select(F.col("url").alias("value")).distinct(), path, "/fr/")
    return spark.read.text(path).select("route", "value")


@query(
    "sink_json_lines",
    "SELECT c_custkey AS cust_key, c_name AS cust_name, c_mktsegment AS market_segment, c_acctbal AS acct_bal FROM customer",
)
def sink_json_lines(spark, sf):
    path = new_dir(spark, "json-lines")
    rows = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custKey"),
        F.col("c_name").alias("custName"),
        F.col("c_mktsegment").alias("marketSegment"),
        F.col("c_acctbal").alias("acctBal"),
    )
    out.write_json_lines(rows, path)
    return files.read_json(spark, path, "cust_key bigint, cust_name string, market_segment string, acct_bal double")


@query("partition_concat", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(url)) AS BIGINT) AS n_chars FROM pages")
def partition_concat(spark, sf):
    joined = out.partition_concat(fx.table(spark, sf, "pages").select(F.col("url").alias("value")))
    return joined.agg(F.sum("n").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("sink_append", f"SELECT 'u' || (user_id % 20) AS key, CAST(floor(epoch(ts)) AS INTEGER) AS sec, {K} AS val, event_id AS seq FROM events")
def sink_append(spark, sf):
    path = new_dir(spark, "append")
    rows = fx.readings(spark, sf, stream=True)
    out.append_stream(rows, path, new_dir(spark, "append-checkpoint")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_upsert",
    f"""
SELECT {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id, {STATUS} AS order_status, {seconds('o_orderdate')} + 600 AS ts
FROM orders JOIN customer ON o_custkey = c_custkey
""",
)
def sink_upsert(spark, sf):
    """Order changes as a stream of files, a few per batch, into a keyed table."""
    staged, target = new_dir(spark, "orders"), new_dir(spark, "upsert")
    data = F.col("data")
    log = fx.order_info_changes(spark, sf).select(
        data["id"].alias("id"), data["user_id"].alias("user_id"), data["order_status"].alias("order_status"), "ts"
    )
    log.write.parquet(staged)
    table = KeyedTable(spark, target, ("id",))
    table.stream(stream_table(spark, staged, log.schema, per_batch=4), new_dir(spark, "upsert-checkpoint")).awaitTermination()
    return table.read()
