"""Change-log clean-up, configuration, routing and dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.catalog.registry import query
from tidewater.catalog.sqltext import CHANGES, ID, seconds, text
from tidewater.functions.values import keep_columns
from tidewater.operators import changes
from tidewater.operators.routing import dim_route, dim_route_at
from tidewater.plans import warehouse
from tidewater.sinks.changes import read_changes, write_changes
from tidewater.sinks.epochs import read_epochs, write_epochs
from tidewater.sinks.files import write_by_target
from tidewater.sinks.keyed import cell_rows
from tidewater.session import new_dir
from tidewater.sources import lines as src
from tidewater.streaming.run import stream_table

DB = fx.DATABASE


def _per_table(log):
    return log.groupBy(F.col("table").alias("tbl"), "type").agg(F.count("*").alias("n"), F.sum("ts").alias("ts_sum"))


PER_TABLE = "SELECT tbl, type, count(*) AS n, CAST(sum(ts) AS BIGINT) AS ts_sum FROM changes"


@query(
    "dim_etl",
    f"WITH {CHANGES} {PER_TABLE} WHERE type IN ('insert', 'update', 'delete', 'bootstrap-insert') GROUP BY tbl, type",
)
def dim_etl(spark, sf):
    return _per_table(changes.dim_etl(fx.change_log(spark, sf), DB))


@query("drop_bootstrap", f"WITH {CHANGES} {PER_TABLE} WHERE type NOT LIKE 'bootstrap-%' GROUP BY tbl, type")
def drop_bootstrap(spark, sf):
    return _per_table(changes.drop_bootstrap(fx.change_log(spark, sf)))


# Rows of the three configured dimension tables, as they come in.
DIM_CHANGES = f"""
dim_changes AS (
  SELECT 'dim_user_info' AS sink_table, {text('c_custkey')} AS id, c_name AS name, c_mktsegment AS segment,
    CASE WHEN c_custkey % 4 = 3 THEN 'bootstrap-insert' ELSE 'insert' END AS type, 1 AS ts FROM customer
  UNION ALL SELECT 'dim_user_info', {text('c_custkey')}, c_name || '-u',
    CASE WHEN c_custkey % 10 = 1 THEN '' ELSE c_mktsegment END, 'update', 2 FROM customer WHERE c_custkey % 4 IN (1, 2)
  UNION ALL SELECT 'dim_user_info', {text('c_custkey')}, c_name, c_mktsegment, 'delete', 3 FROM customer WHERE c_custkey % 4 = 2
  UNION ALL SELECT 'dim_user_info', {text('c_custkey')}, c_name, NULL, 'insert', 4 FROM customer WHERE c_custkey % 8 = 2
  UNION ALL SELECT 'dim_base_province', {text('n_nationkey')}, n_name, NULL, 'bootstrap-insert', 1 FROM nation
  UNION ALL SELECT 'dim_sku_info', {text('p_partkey')}, p_name, NULL, 'bootstrap-insert', 1 FROM part
)"""


def dim_columns(df, *extra):
    data = F.col("data")
    return df.select(
        "sink_table", "row_key", *extra, data["id"].alias("id"), data["name"].alias("name"), data["segment"].alias("segment")
    )


@query(
    "dim_route",
    f"""
WITH {DIM_CHANGES}
SELECT sink_table, id AS row_key, type, CAST(ts AS BIGINT) AS ts, type AS data_type, CAST(NULL AS VARCHAR) AS pruned,
  id, name, segment
FROM dim_changes
""",
)
def route_dims(spark, sf):
    routed = dim_route(changes.dim_etl(fx.change_log(spark, sf), DB), fx.dim_config(spark))
    data = F.col("data")
    return dim_columns(routed, "type", "ts", data["type"].alias("data_type"), data["nation_id"].alias("pruned"))


@query(
    "prune_columns",
    f"""
SELECT {text('n_nationkey')} AS id, n_name AS name, CAST(NULL AS VARCHAR) AS region_id, CAST(2 AS INTEGER) AS n_columns FROM nation
UNION ALL SELECT {text('p_partkey')}, p_name, NULL, 2 FROM part
UNION ALL SELECT {text('s_suppkey')}, s_name, NULL, 2 FROM supplier
""",
)
def prune_columns(spark, sf):
    log = fx.static_changes(spark, sf).where("type <> 'bootstrap-start'")
    kept = log.select(keep_columns(F.col("data"), F.lit("id,name")).alias("data"))
    data = F.col("data")
    return kept.select(
        data["id"].alias("id"), data["name"].alias("name"), data["region_id"].alias("region_id"), F.size("data").alias("n_columns")
    )


DIM_ROWS = f"""
SELECT 'dim_user_info' AS sink_table, {text('c_custkey')} AS row_key, {text('c_custkey')} AS id,
  CASE WHEN c_custkey % 4 = 1 THEN c_name || '-u' ELSE c_name END AS name,
  CASE WHEN c_custkey % 4 <> 2 THEN c_mktsegment END AS segment
FROM customer WHERE c_custkey % 4 <> 2 OR c_custkey % 8 = 2
"""


@query("dim_upsert_delete", DIM_ROWS)
def dim_upsert_delete(spark, sf):
    routed = dim_route(fx.user_changes(spark, sf), fx.dim_config(spark))
    return dim_columns(cell_rows(routed))


@query(
    "dim_tables",
    DIM_ROWS
    + f"""
UNION ALL SELECT 'dim_base_province', {text('n_nationkey')}, {text('n_nationkey')}, n_name, NULL FROM nation
UNION ALL SELECT 'dim_sku_info', {text('p_partkey')}, {text('p_partkey')}, p_name, NULL FROM part
""",
)
def dim_tables(spark, sf):
    return dim_columns(warehouse.dimension_rows(fx.change_log(spark, sf), fx.dim_config(spark), DB))


ROUTE_AT_SQL = f"""
WITH config AS (
  SELECT n_nationkey AS n, 788918400 + n_nationkey * 90 * 86400 AS since FROM nation),
moved AS (
  SELECT {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id, {text('c_nationkey')} AS province_id, kind, {seconds('o_orderdate')} + later AS ts
  FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('insert', 0), ('update', 600)) v(kind, later))
SELECT 'dim_order_' || n AS sink_table, id AS row_key, kind AS type, ts, user_id, CASE WHEN n % 2 = 1 THEN province_id END AS province_id
FROM moved ASOF JOIN config ON ts >= since WHERE n % 7 <> 6
"""


def _order_rows(routed):
    data = F.col("data")
    return routed.select("sink_table", "row_key", "type", "ts", data["user_id"].alias("user_id"), data["province_id"].alias("province_id"))


@query("dim_route_at", ROUTE_AT_SQL)
def route_dims_at(spark, sf):
    """Each change goes where the configuration of its own time sends it."""
    log = changes.dim_etl(fx.change_log(spark, sf, "order_info"), DB)
    return _order_rows(dim_route_at(log, fx.order_config_changes(spark, sf), "ts", 30 * 86_400))


#: Orders that one file of a step of the order log may hold, about.
ORDERS_A_FILE = 250_000


def write_step(rows, path, files, deal=True):
    """A step of a log as ``files`` files, each by a task of its own, so that a batch of so many files is the step.

    Without ``deal`` rows stay with the splits they come in, which saves their shuffle.
    """
    dealt = rows.repartition(files) if deal and files > 1 else rows.coalesce(files)
    dealt.write.parquet(path)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(path)
    for _ in range(files - len(staged.inputFiles())):  # tasks without rows write no file
        staged.limit(0).coalesce(1).write.mode("append").parquet(path)


@query("dim_route_at_stream", ROUTE_AT_SQL)
def route_dims_at_stream(spark, sf):
    """Both logs as streams that advance a year or two at a time."""
    log, config = fx.change_log(spark, sf, "order_info"), fx.order_config_changes(spark, sf)
    paths = [new_dir(spark, "route-log"), new_dir(spark, "route-config")]
    files = [-(-fx.table(spark, sf, "orders").count() // ORDERS_A_FILE) or 1, 1]
    for year in (0, 1997, 1999, 2100):
        for rows, path, at, n in ((log, paths[0], "ts", files[0]), (config, paths[1], "seq", files[1])):
            years = F.year(F.timestamp_seconds(at))
            until = {0: years < 1997, 1997: (years >= 1997) & (years < 1999), 1999: years >= 1999, 2100: F.lit(False)}[year]
            write_step(rows.where(until), f"{path}/{year:04d}", n if year < 2100 else 1)
    streams = [stream_table(spark, p, r.schema, per_batch=n, recursiveFileLookup="true") for p, r, n in zip(paths, (log, config), files)]
    out = new_dir(spark, "routed")
    warehouse.dimension_stream_at(*streams, out, new_dir(spark, "route-checkpoint"), DB, "ts").awaitTermination()
    return _order_rows(spark.read.parquet(out))


SPLIT_SQL = f"""
SELECT 'dwd_user_register' AS sink_table, {text('c_custkey')} AS id, c_name AS name, CAST(NULL AS VARCHAR) AS sku_id,
  CAST(t AS BIGINT) AS ts, {text('t')} AS data_ts
FROM customer, (VALUES (1), (4)) v(t) WHERE (t = 1 AND c_custkey % 4 <> 3) OR (t = 4 AND c_custkey % 8 = 2)
UNION ALL
SELECT 'dwd_cart_update', {ID}, NULL, {text('l_partkey')}, {seconds('o_orderdate')} + l_linenumber,
  {text(seconds('o_orderdate') + ' + l_linenumber')}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber > 1
"""


def _split(df):
    data = F.col("data")
    return df.select(
        "sink_table", data["id"].alias("id"), data["name"].alias("name"), data["sku_id"].alias("sku_id"), "ts", data["ts"].alias("data_ts")
    )


@query("dwd_route", SPLIT_SQL)
def dwd_route(spark, sf):
    return _split(warehouse.split_changes(fx.change_log(spark, sf), fx.split_config(spark)))


@query("dwd_route_stored", SPLIT_SQL)
def dwd_route_stored(spark, sf):
    """The log lies in folders by table and kind; the configuration decides at run time which of them are read."""
    path = new_dir(spark, "changes")
    write_changes(fx.change_log(spark, sf), path)
    return _split(warehouse.split_changes(read_changes(spark, path), fx.split_config(spark)))


@query("sink_dynamic", SPLIT_SQL)
def sink_dynamic(spark, sf):
    path = new_dir(spark, "split")
    write_by_target(warehouse.split_changes(fx.change_log(spark, sf), fx.split_config(spark)), path)
    return _split(spark.read.parquet(path))


@query("sink_dynamic_epochs", SPLIT_SQL)
def sink_dynamic_epochs(spark, sf):
    """The split rows as a stream into one target per table, epoch by epoch, and read back by their labels."""
    staged, path = new_dir(spark, "split-rows"), new_dir(spark, "epochs")
    split = warehouse.split_changes(fx.change_log(spark, sf), fx.split_config(spark))
    split.select(F.col("sink_table").alias("target"), F.to_json(F.struct("data", "ts")).alias("value")).write.parquet(staged)
    rows = stream_table(spark, staged, "target string, value string", per_batch=4)
    write_epochs(rows, path, new_dir(spark, "epochs-checkpoint"), part_bytes=100_000).awaitTermination()
    row = F.from_json("value", "data map<string,string>, ts bigint").alias("row")
    return _split(read_epochs(spark, path).select(F.col("target").alias("sink_table"), row).select("sink_table", "row.*"))


CONFIG = """
config AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'u' WHEN 'O' THEN 'c' ELSE 'd' END AS op, 't' || o_custkey AS source_table,
    'dim_t' || o_custkey AS sink_table, 'id,c' || (o_orderkey % 5) AS sink_columns, 'info' AS sink_family,
    'id' AS sink_row_key, o_orderkey AS seq
  FROM orders
)"""


@query("src_cdc_config", f"WITH {CONFIG} SELECT * FROM config")
def src_cdc_config(spark, sf):
    return src.config_changes(fx.config_change_lines(spark, sf))


@query(
    "config_snapshot",
    f"""
WITH {CONFIG}, ranked AS (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn FROM config)
SELECT source_table, sink_table, sink_columns, sink_family, sink_row_key FROM ranked WHERE rn = 1 AND op <> 'd'
""",
)
def config_snapshot(spark, sf):
    return changes.config_snapshot(src.config_changes(fx.config_change_lines(spark, sf)))
