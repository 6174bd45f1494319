"""Shared pieces of the checking SQL, written from the base tables and not from the derived logs."""


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(16,2)) AS VARCHAR)"


def when(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def seconds(x: str) -> str:
    return f"CAST(epoch({x}) AS BIGINT)"


ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

DETAIL = f"""
detail AS (
  SELECT {ID} AS id, {text('l_orderkey')} AS order_id, {text('o_custkey')} AS user_id,
    {text('l_partkey')} AS sku_id, p_name AS sku_name, {text('c_nationkey')} AS province_id,
    act.activity_id, act.activity_rule_id, cou.coupon_id,
    strftime(o_orderdate, '%Y-%m-%d') AS date_id, {when('o_orderdate')} AS create_time,
    {text('CAST(l_quantity AS INTEGER)')} AS sku_num,
    {text('CAST(l_quantity AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2))')} AS split_original_amount,
    {money('l_discount')} AS split_activity_amount, {money('l_tax')} AS split_coupon_amount,
    {money('l_extendedprice')} AS split_total_amount, {seconds('o_orderdate')} AS ts,
    o_orderkey, o_orderdate, o_orderstatus, o_orderpriority
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  LEFT JOIN (SELECT {ID} AS aid, {text('l_suppkey')} AS activity_id, {text('l_linenumber')} AS activity_rule_id
             FROM lineitem WHERE l_discount >= 0.05) act ON {ID} = act.aid
  LEFT JOIN (SELECT {ID} AS cid, {text('l_suppkey % 10')} AS coupon_id
             FROM lineitem WHERE l_tax >= 0.04) cou ON {ID} = cou.cid
)"""

DETAIL_COLUMNS = """id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
  date_id, create_time, sku_num, split_original_amount, split_activity_amount, split_coupon_amount,
  split_total_amount, ts"""

DIC = """
dic AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dic_code, substr(o_orderpriority, 3) AS dic_name
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '4'
)"""

STATUS = "CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1006' END"

# One row per change of a table with at least its type and time.
CHANGES = f"""
changes AS (
  SELECT 'order_detail' AS tbl, 'insert' AS type, {seconds('o_orderdate')} AS ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'order_info', 'insert', {seconds('o_orderdate')} FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'order_info', 'update', {seconds('o_orderdate')} + 600 FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'order_detail_activity', 'insert', {seconds('o_orderdate')}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount >= 0.05
  UNION ALL SELECT 'order_detail_coupon', 'insert', {seconds('o_orderdate')}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax >= 0.04
  UNION ALL SELECT 'payment_info', 'update', {seconds('o_orderdate')} + o_orderkey % 2400 FROM orders
  UNION ALL SELECT t, y, {seconds('l_shipdate')} FROM lineitem JOIN orders ON l_orderkey = o_orderkey,
    (VALUES ('order_refund_info', 'insert'), ('order_refund_info', 'update'), ('refund_payment', 'update')) v(t, y)
    WHERE l_returnflag = 'R'
  UNION ALL SELECT 'cart_info', CASE WHEN l_linenumber = 1 THEN 'insert' ELSE 'update' END,
    {seconds('o_orderdate')} + l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'comment_info', 'insert', 1704067200 + doc_id FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT 'user_info', CASE WHEN c_custkey % 4 = 3 THEN 'bootstrap-insert' ELSE 'insert' END, 1 FROM customer
  UNION ALL SELECT 'user_info', 'update', 2 FROM customer WHERE c_custkey % 4 IN (1, 2)
  UNION ALL SELECT 'user_info', 'delete', 3 FROM customer WHERE c_custkey % 4 = 2
  UNION ALL SELECT 'user_info', 'insert', 4 FROM customer WHERE c_custkey % 8 = 2
  UNION ALL SELECT 'base_province', 'bootstrap-insert', 1 FROM nation
  UNION ALL SELECT 'sku_info', 'bootstrap-insert', 1 FROM part
  UNION ALL SELECT 'seller_info', 'insert', 1 FROM supplier
  UNION ALL SELECT 'base_province', 'bootstrap-start', n_nationkey FROM nation
)"""

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Application log records, flat.
LOG = f"""
log AS (
  SELECT event_id AS seq, ts AS et, epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS day, event_type, {K} AS k,
    {text('user_id')} AS mid, user_id || '-' || strftime(ts, '%Y-%m-%d') AS sid,
    'v' || (user_id % 3) AS vc, 'ch' || (user_id % 4) AS ch, {text('user_id % 7')} AS ar,
    CASE WHEN event_id % 3 = 0 THEN '1' ELSE '0' END AS is_new,
    CAST(round(value * 100) AS BIGINT) AS during_time,
    CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'home' ELSE 'cart' END AS last_page_id,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'keyword' ELSE 'sku' END AS item_type,
    CASE WHEN {K} % 10 <> 0 THEN p_name END AS item,
    CASE WHEN event_type = 'view' THEN {K} % 3 ELSE 0 END AS n_displays,
    CASE WHEN event_type = 'click' THEN {K} % 2 + 1 ELSE 0 END AS n_actions
  FROM events JOIN part ON {K} = p_partkey
)"""

READINGS = f"""
readings AS (
  SELECT 'u' || (user_id % 20) AS key, CAST(floor(epoch(ts)) AS INTEGER) AS sec, {K} AS val, event_id AS seq FROM events
)"""


def openers(rows: str) -> str:
    """Moments that open a session of one hour per sid, as a recursive walk from opener to opener."""
    return f"""
nxt AS (
  SELECT a.sid, a.ts, min(b.ts) AS nts FROM {rows} a JOIN {rows} b ON a.sid = b.sid AND b.ts >= a.ts + 3600000
  GROUP BY a.sid, a.ts
),
moments AS (
  SELECT sid, min(ts) AS ts FROM {rows} GROUP BY sid
  UNION ALL
  SELECT nxt.sid, nxt.nts FROM moments JOIN nxt ON moments.sid = nxt.sid AND moments.ts = nxt.ts
),
opened AS (
  SELECT m.sid, m.ts, min(r.seq) AS seq FROM moments m JOIN {rows} r ON r.sid = m.sid AND r.ts = m.ts GROUP BY m.sid, m.ts
)"""
