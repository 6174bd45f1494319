"""Facts of trade and interaction, and the change-log filters under them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.catalog.registry import query
from tidewater.catalog.sqltext import DETAIL, DETAIL_COLUMNS, DIC, ID, STATUS, money, seconds, text, when
from tidewater.operators import changes, facts

DB = fx.DATABASE
ORDER_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")

DETAIL_SQL = f"WITH {DETAIL} SELECT {DETAIL_COLUMNS} FROM detail"

PAY_SQL = f"""
WITH {DETAIL}, {DIC}
SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
  dic_code AS payment_type_code, dic_name AS payment_type_name,
  {when("o_orderdate + to_seconds(o_orderkey % 2400)")} AS callback_time, sku_num, split_original_amount,
  split_activity_amount, split_coupon_amount, split_total_amount AS split_payment_amount, ts + o_orderkey % 2400 AS ts
FROM detail JOIN dic ON substr(o_orderpriority, 1, 1) = dic_code
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_orderkey % 2400 BETWEEN 5 AND 1800
"""


@query("trade_order_detail", DETAIL_SQL)
def trade_order_detail(spark, sf):
    return facts.trade_order_detail(fx.change_log(spark, sf, *ORDER_TABLES), DB)


@query(
    "order_cancel",
    f"""
WITH {DETAIL}
SELECT {DETAIL_COLUMNS.replace("date_id, create_time",
    "strftime(o_orderdate + INTERVAL 10 MINUTE, '%Y-%m-%d') AS date_id, "
    + when("o_orderdate + INTERVAL 10 MINUTE") + " AS create_time")}
FROM detail WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')
""",
)
def order_cancel(spark, sf):
    log = fx.change_log(spark, sf, *ORDER_TABLES)
    return facts.order_cancel(facts.trade_order_detail(log, DB), log, DB)


@query("order_pay_success", PAY_SQL)
def order_pay_success(spark, sf):
    log = fx.change_log(spark, sf, *ORDER_TABLES, "payment_info")
    return facts.order_pay_success(facts.trade_order_detail(log, DB), log, fx.dictionary(spark, sf), DB)


@query(
    "order_refund",
    f"""
WITH {DIC}
SELECT {ID} AS id, {text('o_custkey')} AS user_id, {text('l_orderkey')} AS order_id, {text('l_partkey')} AS sku_id,
  {text('c_nationkey')} AS province_id, strftime(l_shipdate, '%Y-%m-%d') AS date_id, {when('l_shipdate')} AS create_time,
  d1.dic_code AS refund_type_code, d1.dic_name AS refund_code_name, d2.dic_code AS refund_reason_type_code,
  d2.dic_name AS refund_reason_type_name, 'r' || d2.dic_code AS refund_reason_txt,
  {text('CAST(l_quantity AS INTEGER)')} AS refund_num, {money('l_extendedprice')} AS refund_amount,
  {seconds('l_shipdate')} AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN dic d1 ON d1.dic_code = {text('l_linenumber % 5 + 1')} JOIN dic d2 ON d2.dic_code = {text('l_suppkey % 5 + 1')}
WHERE l_returnflag = 'R' AND o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED'
""",
)
def order_refund(spark, sf):
    return facts.order_refund(fx.change_log(spark, sf, "order_info", "refund"), fx.dictionary(spark, sf), DB)


@query(
    "refund_pay_success",
    f"""
WITH {DIC}
SELECT concat_ws('-', p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey) AS id, {text('o_custkey')} AS user_id,
  {text('p.l_orderkey')} AS order_id, {text('p.l_partkey')} AS sku_id, {text('c_nationkey')} AS province_id,
  dic_code AS payment_type_code, dic_name AS payment_type_name, strftime(p.l_shipdate, '%Y-%m-%d') AS date_id,
  {when('p.l_shipdate')} AS callback_time, {text('CAST(r.l_quantity AS INTEGER)')} AS refund_num,
  {money('p.l_extendedprice')} AS refund_amount, {seconds('p.l_shipdate')} AS ts
FROM lineitem p JOIN lineitem r ON p.l_orderkey = r.l_orderkey AND p.l_partkey = r.l_partkey
JOIN orders ON p.l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN dic ON dic_code = substr(o_orderpriority, 1, 1)
WHERE p.l_returnflag = 'R' AND p.l_linenumber % 2 = 1 AND r.l_returnflag = 'R' AND r.l_linestatus = 'F'
  AND o_orderstatus = 'O' AND o_orderpriority <> '4-NOT SPECIFIED'
""",
)
def refund_pay_success(spark, sf):
    return facts.refund_pay_success(fx.change_log(spark, sf, "order_info", "refund"), fx.dictionary(spark, sf), DB)


@query(
    "comment_info",
    f"""
WITH {DIC}
SELECT {text('doc_id')} AS id, {text('doc_id % 150')} AS user_id, {text('doc_id % 200')} AS sku_id, dic_code AS appraise,
  dic_name AS appraise_name, text AS comment_txt, 1704067200 + doc_id AS ts
FROM documents JOIN labels USING (doc_id) JOIN dic ON dic_code = {text('quality + 2 * toxic + 1')}
""",
)
def comment_info(spark, sf):
    return facts.comment_info(fx.change_log(spark, sf, "comment_info"), fx.dictionary(spark, sf), DB)


def _versions(rows: str) -> str:
    """Of versions that begin together, the last."""
    return f"versions AS (SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY code, since ORDER BY pos DESC) = 1)"


@query(
    "comment_info_as_of",
    f"""
WITH {_versions(f"""SELECT {text("k % 5 + 1")} AS code, event_type || '-' || k AS name, event_type = 'error' AS gone,
    {seconds("date_trunc('second', ts)")} AS since, event_id AS pos
  FROM (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k FROM events)""")},
comments AS (SELECT *, {text('quality + 2 * toxic + 1')} AS code, 1704067200 + doc_id AS ts FROM documents JOIN labels USING (doc_id))
SELECT {text('doc_id')} AS id, {text('doc_id % 150')} AS user_id, {text('doc_id % 200')} AS sku_id, c.code AS appraise,
  v.name AS appraise_name, text AS comment_txt, ts
FROM comments c ASOF JOIN versions v ON c.code = v.code AND c.ts >= v.since WHERE NOT v.gone
""",
)
def comment_info_as_of(spark, sf):
    return facts.comment_info_as_of(fx.change_log(spark, sf, "comment_info"), fx.grade_versions(spark, sf), DB)


@query(
    "payments_as_of",
    f"""
WITH {_versions(f"""SELECT substr(o_orderpriority, 1, 1) AS code, substr(o_orderpriority, 3) || '-' || (o_orderkey % 1000) AS name,
    o_orderstatus = 'P' AS gone, {seconds('o_orderdate')} AS since, o_orderkey AS pos FROM orders""")},
paid AS (
  SELECT {text('o_orderkey')} AS order_id, substr(o_orderpriority, 1, 1) AS code, {seconds('o_orderdate')} + o_orderkey % 2400 AS ts
  FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')
SELECT order_id, p.code, CASE WHEN NOT v.gone THEN v.name END AS name, ts
FROM paid p ASOF LEFT JOIN versions v ON p.code = v.code AND p.ts >= v.since
""",
)
def payments_as_of(spark, sf):
    return facts.payments_as_of(fx.change_log(spark, sf, "payment_info"), fx.dictionary_versions(spark, sf), DB)


@query(
    "cart_add",
    f"""
SELECT {ID} AS id, {text('o_custkey')} AS user_id, {text('l_partkey')} AS sku_id,
  {text('CAST(l_quantity AS INTEGER) - CASE WHEN l_linenumber = 1 THEN 0 ELSE l_suppkey % 50 END')} AS sku_num,
  {seconds('o_orderdate')} + l_linenumber AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linenumber = 1 OR (l_returnflag <> 'N' AND CAST(l_quantity AS INTEGER) > l_suppkey % 50)
""",
)
def cart_add(spark, sf):
    return changes.cart_add(fx.change_log(spark, sf, "cart_info"), DB)


@query(
    "extract_insert",
    f"""
SELECT {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id, {text('c_nationkey')} AS province_id,
  CAST(NULL AS VARCHAR) AS order_status, {seconds('o_orderdate')} AS ts
FROM orders JOIN customer ON o_custkey = c_custkey
""",
)
def extract_insert(spark, sf):
    rows = changes.rows_of(fx.change_log(spark, sf, "order_info"), "order_info", "insert", DB)
    return changes.pick(rows, "id", "user_id", "province_id", "order_status")


def _updates(spark, sf, condition):
    rows = changes.rows_of(fx.change_log(spark, sf, "order_info"), "order_info", "update", DB).where(condition)
    return changes.pick(rows, "id", "order_status", "operate_time")


UPDATES_SQL = f"""
SELECT {text('o_orderkey')} AS id, {STATUS} AS order_status, {when('o_orderdate + INTERVAL 10 MINUTE')} AS operate_time,
  {seconds('o_orderdate')} + 600 AS ts
FROM orders JOIN customer ON o_custkey = c_custkey
"""


@query("changed_to", UPDATES_SQL + "WHERE o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED'")
def changed_to(spark, sf):
    return _updates(spark, sf, changes.changed_to("order_status", "1005"))


@query("changed_to_strict", UPDATES_SQL + "WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')")
def changed_to_strict(spark, sf):
    return _updates(spark, sf, changes.changed_to_strict("order_status", "1003"))


@query(
    "decimal_amount",
    f"""
SELECT {ID} AS id, {text('CAST(l_quantity AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2))')} AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
""",
)
def decimal_amount(spark, sf):
    rows = facts.order_detail_rows(fx.change_log(spark, sf, "order_detail"), DB)
    return rows.select("id", F.col("split_original_amount").alias("amount"))
