"""Change log, application log and configuration rows derived from the test tables.

Every view is a DataFrame over the given Parquet tables and grows with them; FIXTURES.md describes the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater import schemas
from tidewater.functions.time import DATE_TIME
from tidewater.streaming.run import stream_table

DATABASE = "shop"

_schemas: dict[str, StructType] = {}
_splits: dict[str, int] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file footer once per path."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(spark: SparkSession, sf: str, name: str, *keys: str) -> DataFrame:
    """A test table, distributed by ``keys`` when it comes in fewer splits than cores, like a file of one row group.

    A large table has more splits than the cluster has cores and is returned as it is, without a shuffle.
    """
    df, path = table(spark, sf, name), f"{sf}/{name}.parquet"
    if path not in _splits:
        _splits[path] = df.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if _splits[path] < cores else df


def _text(value: Column) -> Column:
    return value.cast("string")


def _money(value: Column) -> Column:
    return _text(value.cast("decimal(16,2)"))


def _when(value: Column) -> Column:
    return F.date_format(value.cast("timestamp"), DATE_TIME)


def _seconds(value: Column) -> Column:
    return F.unix_seconds(value.cast("timestamp"))


def _map(fields: dict[str, Column] | None) -> Column:
    if fields is None:
        return F.lit(None).cast(schemas.STRINGS)
    return F.create_map(*[part for name, value in fields.items() for part in (F.lit(name), _text(value))])


def _change(
    df: DataFrame, name: str, kind: str | Column, ts: Column, data: dict[str, Column], old: dict[str, Column] | None = None
) -> DataFrame:
    return df.select(
        F.lit(DATABASE).alias("database"),
        F.lit(name).alias("table"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        _map(data).alias("data"),
        _map(old).alias("old"),
        ts.cast("bigint").alias("ts"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return spread(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")


def detail_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def order_detail_changes(spark: SparkSession, sf: str) -> DataFrame:
    line, order, part = lines(spark, sf), table(spark, sf, "orders"), table(spark, sf, "part")
    # joined on the number as the log gives it, so that a join of the log by order finds the lines dealt by it already
    same_order = _text(line.l_orderkey) == _text(order.o_orderkey)
    rows = line.join(part, line.l_partkey == part.p_partkey).join(order, same_order)
    price = _money(F.col("l_extendedprice"))
    rows = rows.select(
        _seconds(F.col("o_orderdate")).alias("ts"),
        detail_id().alias("id"),
        _text(F.col("l_orderkey")).alias("order_id"),
        _text(F.col("l_partkey")).alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        _when(F.col("o_orderdate")).alias("create_time"),
        _text(F.col("l_quantity").cast("int")).alias("sku_num"),
        price.alias("order_price"),
        _money(F.col("l_discount")).alias("split_activity_amount"),
        _money(F.col("l_tax")).alias("split_coupon_amount"),
    )
    names = ("id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price")
    amounts = {"split_total_amount": F.col("order_price")} | {c: F.col(c) for c in ("split_activity_amount", "split_coupon_amount")}
    return _change(rows, "order_detail", "insert", F.col("ts"), {c: F.col(c) for c in names} | amounts)


def order_info_changes(spark: SparkSession, sf: str) -> DataFrame:
    order, customer = spread(spark, sf, "orders", "o_orderkey"), table(spark, sf, "customer")
    rows = order.join(customer, order.o_custkey == customer.c_custkey)
    base = {"id": F.col("o_orderkey"), "user_id": F.col("o_custkey"), "province_id": F.col("c_nationkey")}
    status = F.when(F.col("o_orderstatus") == "F", "1003").when(F.col("o_orderstatus") == "P", "1005").otherwise("1006")
    before = (
        F.when(F.col("o_orderpriority") == "5-LOW", status)
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise("1001")
    )
    operate = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL '10' MINUTE")
    insert = _change(rows, "order_info", "insert", _seconds(F.col("o_orderdate")), base)
    update = _change(
        rows,
        "order_info",
        "update",
        _seconds(operate),
        {**base, "order_status": status, "operate_time": _when(operate)},
        {"order_status": before},
    )
    return _union([insert, update])


def activity_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _change(
        lines(spark, sf)
        .where("l_discount >= 0.05")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")),
        "order_detail_activity",
        "insert",
        _seconds(F.col("o_orderdate")),
        {"order_detail_id": detail_id(), "activity_id": F.col("l_suppkey"), "activity_rule_id": F.col("l_linenumber")},
    )


def coupon_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _change(
        lines(spark, sf)
        .where("l_tax >= 0.04")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")),
        "order_detail_coupon",
        "insert",
        _seconds(F.col("o_orderdate")),
        {"order_detail_id": detail_id(), "coupon_id": F.col("l_suppkey") % 10},
    )


def payment_changes(spark: SparkSession, sf: str) -> DataFrame:
    callback = F.timestamp_seconds(_seconds(F.col("o_orderdate")) + F.col("o_orderkey") % 2400)
    return _change(
        spread(spark, sf, "orders", "o_orderkey"),
        "payment_info",
        "update",
        F.unix_seconds(callback),
        {
            "user_id": F.col("o_custkey"),
            "order_id": F.col("o_orderkey"),
            "payment_type": F.substring("o_orderpriority", 1, 1),
            "callback_time": _when(callback),
            "payment_status": F.when(F.col("o_orderstatus") != "P", "1602").otherwise("1601"),
        },
        {"payment_status": F.when(F.col("o_orderpriority") != "5-LOW", "1601")},
    )


def refund_changes(spark: SparkSession, sf: str) -> DataFrame:
    line, order = lines(spark, sf).where("l_returnflag = 'R'"), table(spark, sf, "orders")
    rows = line.join(order, line.l_orderkey == order.o_orderkey)
    base = {
        "id": detail_id(),
        "user_id": F.col("o_custkey"),
        "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"),
        "refund_type": F.col("l_linenumber") % 5 + 1,
        "refund_num": F.col("l_quantity").cast("int"),
        "refund_amount": _money(F.col("l_extendedprice")),
        "refund_reason_type": F.col("l_suppkey") % 5 + 1,
        "refund_reason_txt": F.concat(F.lit("r"), _text(F.col("l_suppkey") % 5 + 1)),
        "create_time": _when(F.col("l_shipdate")),
    }
    ts = _seconds(F.col("l_shipdate"))
    insert = _change(rows, "order_refund_info", "insert", ts, base)
    update = _change(
        rows,
        "order_refund_info",
        "update",
        ts,
        {**base, "refund_status": F.when(F.col("l_linestatus") == "F", "0705").otherwise("0701")},
        {"refund_status": F.lit("0701")},
    )
    paid = _change(
        rows,
        "refund_payment",
        "update",
        ts,
        {
            "id": detail_id(),
            "order_id": F.col("l_orderkey"),
            "sku_id": F.col("l_partkey"),
            "payment_type": F.substring("o_orderpriority", 1, 1),
            "callback_time": _when(F.col("l_shipdate")),
            "total_amount": _money(F.col("l_extendedprice")),
            "refund_status": F.when(F.col("l_linenumber") % 2 == 1, "1602").otherwise("1601"),
        },
        {"refund_status": F.lit("1601")},
    )
    return _union([insert, update, paid])


def cart_changes(spark: SparkSession, sf: str) -> DataFrame:
    line, order = lines(spark, sf), table(spark, sf, "orders")
    rows = line.join(order, line.l_orderkey == order.o_orderkey)
    return _change(
        rows,
        "cart_info",
        F.when(F.col("l_linenumber") == 1, "insert").otherwise("update"),
        _seconds(F.col("o_orderdate")) + F.col("l_linenumber"),
        {
            "id": detail_id(),
            "user_id": F.col("o_custkey"),
            "sku_id": F.col("l_partkey"),
            "sku_num": F.col("l_quantity").cast("int"),
        },
        {
            # absent for first rows and for flag N, else a number on either side of sku_num
            "sku_num": F.when((F.col("l_linenumber") > 1) & (F.col("l_returnflag") != "N"), F.col("l_suppkey") % 50)
        },
    )


def comment_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(spark, sf, "documents", "doc_id").join(table(spark, sf, "labels"), "doc_id")
    return _change(
        rows,
        "comment_info",
        "insert",
        F.lit(1704067200) + F.col("doc_id"),
        {
            "id": F.col("doc_id"),
            "user_id": F.col("doc_id") % 150,
            "sku_id": F.col("doc_id") % 200,
            "appraise": F.col("quality") + 2 * F.col("toxic") + 1,
            "comment_txt": F.col("text"),
            "create_time": F.lit("2024-01-01 00:00:00"),
        },
    )


def user_changes(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    key = F.col("c_custkey")
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    rest = {"nation_id": F.col("c_nationkey"), "balance": _money(F.col("c_acctbal"))}
    ident = {"id": key, "name": name, "segment": segment, **rest}
    created = _change(
        customer, "user_info", F.when(key % 4 == 3, "bootstrap-insert").otherwise("insert"), F.lit(1), ident
    )
    renamed = {"id": key, "name": F.concat(name, F.lit("-u")), **rest}
    # an empty segment leaves the stored cell alone
    renamed["segment"] = F.when(key % 10 == 1, "").otherwise(segment)
    updated = _change(customer.where(key % 4 > 0).where(key % 4 < 3), "user_info", "update", F.lit(2), renamed, {"name": name})
    deleted = _change(customer.where(key % 4 == 2), "user_info", "delete", F.lit(3), ident)
    again = _change(customer.where(key % 8 == 2), "user_info", "insert", F.lit(4), {"id": key, "name": name, **rest})
    return _union([created, updated, deleted, again])


def static_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Tables loaded once, one table without configuration and markers of the initial load."""
    nation, part, supplier = (table(spark, sf, t) for t in ("nation", "part", "supplier"))
    province = _change(
        nation, "base_province", "bootstrap-insert", F.lit(1), {"id": F.col("n_nationkey"), "name": F.col("n_name"), "region_id": F.col("n_regionkey")}
    )
    sku = _change(
        part, "sku_info", "bootstrap-insert", F.lit(1), {"id": F.col("p_partkey"), "name": F.col("p_name"), "brand": F.col("p_brand")}
    )
    unknown = _change(supplier, "seller_info", "insert", F.lit(1), {"id": F.col("s_suppkey"), "name": F.col("s_name")})
    marker = nation.select(
        F.lit(DATABASE).alias("database"),
        F.lit("base_province").alias("table"),
        F.lit("bootstrap-start").alias("type"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("data"),
        _map(None).alias("old"),
        F.col("n_nationkey").cast("bigint").alias("ts"),
    )
    return _union([province, sku, unknown, marker])


LOG_TABLES = {
    "order_detail": order_detail_changes,
    "order_info": order_info_changes,
    "order_detail_activity": activity_changes,
    "order_detail_coupon": coupon_changes,
    "payment_info": payment_changes,
    "refund": refund_changes,  # order_refund_info and refund_payment
    "cart_info": cart_changes,
    "comment_info": comment_changes,
    "user_info": user_changes,
    "static": static_changes,
}


def change_log(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """The change log, or its part about some tables. A filter on ``table`` prunes the branches of all others."""
    return _union([LOG_TABLES[name](spark, sf) for name in names or LOG_TABLES])


def broken(value: Column, seq: Column) -> Column:
    """Text with its last character cut off in every 97th row, to exercise the dead-letter path."""
    return F.when(seq % 97 == 0, F.expr("substring(value, 1, length(value) - 1)")).otherwise(value)


def order_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order changes as JSON lines, some of them cut short."""
    log = order_info_changes(spark, sf)
    lines = log.select(F.to_json(F.struct(*log.columns)).alias("value"), log["data"]["id"].cast("bigint").alias("seq"))
    return lines.select(broken(F.col("value"), F.col("seq")).alias("value"))


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Code table out of the order priorities; code 4 is missing so that inner lookups drop rows."""
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("n"))
        .select(
            F.substring("o_orderpriority", 1, 1).alias("dic_code"),
            F.struct(F.expr("substring(o_orderpriority, 3)").alias("dic_name")).alias("info"),
        )
        .where("dic_code <> '4'")
    )


def dictionary_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A changing code table: each order gives the code of its priority another name, or ends it where it is partial."""
    order = spread(spark, sf, "orders", "o_orderkey")
    name = F.concat(F.expr("substring(o_orderpriority, 3)"), F.lit("-"), _text(F.col("o_orderkey") % 1000))
    return order.select(
        F.substring("o_orderpriority", 1, 1).alias("dic_code"),
        F.struct(name.alias("dic_name")).alias("info"),
        F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("op"),
        _seconds(F.col("o_orderdate")).alias("since"),
        F.col("o_orderkey").cast("bigint").alias("pos"),
    )


def grade_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A code table of comment grades that events change while comments come in."""
    event = events(spark, sf)
    return event.select(
        _text(F.col("k") % 5 + 1).alias("dic_code"),
        F.struct(F.concat("event_type", F.lit("-"), _text(F.col("k"))).alias("dic_name")).alias("info"),
        F.when(F.col("event_type") == "error", "d").otherwise("u").alias("op"),
        F.unix_seconds("et").alias("since"),
        F.col("event_id").cast("bigint").alias("pos"),
    )


def dim_config(spark: SparkSession) -> DataFrame:
    rows = [
        ("user_info", "dim_user_info", "id,name,segment", "info", "id"),
        ("base_province", "dim_base_province", "id,name", "info", "id"),
        ("sku_info", "dim_sku_info", "id,name", "info", "id"),
    ]
    return spark.createDataFrame(rows, schemas.DIM_CONFIG)


def split_config(spark: SparkSession) -> DataFrame:
    rows = [
        ("user_info", "insert", "dwd_user_register", "id,name"),
        ("cart_info", "update", "dwd_cart_update", "id,sku_id"),
    ]
    return spark.createDataFrame(rows, schemas.SPLIT_CONFIG)


def order_config_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The configuration of one table as it changes: each nation sends orders elsewhere for a quarter, some to nowhere."""
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, sf, "nation").select(
        F.when(key % 7 == 6, "d").otherwise("u").alias("op"),
        F.lit("order_info").alias("source_table"),
        F.concat(F.lit("dim_order_"), _text(key)).alias("sink_table"),
        F.when(key % 2 == 0, "id,user_id").otherwise("id,user_id,province_id").alias("sink_columns"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"),
        (F.lit(788_918_400) + key * 90 * 86_400).alias("seq"),  # 1995-01-01 and every 90 days
    )


def config_change_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Configuration changes as JSON lines: each order changes the entry of its customer."""
    order = spread(spark, sf, "orders", "o_orderkey")
    key = F.col("o_orderkey")
    op = F.when(F.col("o_orderstatus") == "F", "u").when(F.col("o_orderstatus") == "O", "c").otherwise("d")
    source = F.concat(F.lit("t"), _text(F.col("o_custkey")))
    row = F.struct(
        source.alias("source_table"),
        F.concat(F.lit("dim_"), source).alias("sink_table"),
        F.concat(F.lit("id,c"), _text(key % 5)).alias("sink_columns"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"),
    )
    change = F.struct(
        op.alias("op"),
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        key.alias("seq"),
    )
    return order.select(F.to_json(change).alias("value"))


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table as a stream of its one file."""
    return stream_table(spark, sf, table(spark, sf, name).schema, pathGlobFilter=f"{name}.parquet")


def events(spark: SparkSession, sf: str, stream: bool = False) -> DataFrame:
    """Events with a proper timestamp and the number inside ``props``."""
    source = stream_of(spark, sf, "events") if stream else spread(spark, sf, "events", "event_id")
    return source.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("et"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def app_log(spark: SparkSession, sf: str, stream: bool = False) -> DataFrame:
    event, part = events(spark, sf, stream), table(spark, sf, "part")
    rows = event.join(part.select("p_partkey", "p_name"), F.col("k") == F.col("p_partkey"))
    kind, k = F.col("event_type"), F.col("k")
    ms = F.unix_millis("et")
    user = _text(F.col("user_id"))

    def items(prefix: str, count: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.create_map(
                F.lit("item"), F.concat(F.lit(prefix), _text(k)), F.lit("pos"), _text(i)
            ),
        )

    none = F.lit(None)
    return rows.select(
        F.struct(
            user.alias("mid"),
            F.concat(F.lit("v"), _text(F.col("user_id") % 3)).alias("vc"),
            F.concat(F.lit("ch"), _text(F.col("user_id") % 4)).alias("ch"),
            _text(F.col("user_id") % 7).alias("ar"),
            F.when(F.col("event_id") % 3 == 0, "1").otherwise("0").alias("is_new"),
            F.concat(user, F.lit("-"), F.date_format("et", "yyyy-MM-dd")).alias("sid"),
        ).alias("common"),
        F.create_map(
            F.lit("during_time"), _text(F.round(F.col("value") * 100).cast("bigint")),
            F.lit("last_page_id"), F.when(kind == "view", "search").when(kind == "click", "home").otherwise("cart"),
            F.lit("item_type"), F.when(kind.isin("view", "click", "purchase"), "keyword").otherwise("sku"),
            F.lit("item"), F.when(k % 10 != 0, F.col("p_name")),
        ).alias("page"),
        F.when((kind == "view") & (k % 3 > 0), items("d", k % 3)).alias("displays"),
        F.when(kind == "click", items("a", k % 2 + 1)).alias("actions"),
        F.when(kind == "error", F.create_map(F.lit("code"), _text(k))).otherwise(none).alias("err"),
        F.when(kind == "signup", F.create_map(F.lit("entry"), _text(k))).otherwise(none).alias("start"),
        ms.alias("ts"),
        F.col("event_id").alias("seq"),
    )


def app_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Application log as JSON lines, some of them cut short, with fields that the schema does not name."""
    log = app_log(spark, sf)
    number = F.col("common.mid").cast("bigint")
    trace = F.struct(F.array("seq", number).alias("path"), F.lit(True).alias("sampled"))
    lines = log.withColumn("common", F.col("common").withField("uid", number)).withColumn("trace", trace)
    lines = lines.select(F.to_json(F.struct(*log.columns[:-1], "trace", "seq")).alias("value"), "seq")
    return lines.select(broken(F.col("value"), F.col("seq")).alias("value"))


def readings(spark: SparkSession, sf: str, stream: bool = False) -> DataFrame:
    """Keyed readings ``key, sec, val`` with the arrival order ``seq``."""
    return events(spark, sf, stream).select(
        F.concat(F.lit("u"), _text(F.col("user_id") % 20)).alias("key"),
        F.unix_seconds("et").cast("int").alias("sec"),
        F.col("k").alias("val"),
        F.col("event_id").alias("seq"),
    )


def reading_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Readings as comma text; every 97th line lacks its numbers."""
    rows = readings(spark, sf)
    return rows.select(
        F.when(F.col("seq") % 97 == 0, F.concat(F.col("key"), F.lit(",x")))
        .otherwise(F.concat_ws(",", "key", _text(F.col("sec")), _text(F.col("val"))))
        .alias("value")
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("age"), F.col("c_name").alias("name"))
