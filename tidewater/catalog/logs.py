"""Application log: validation, split and the routed log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.catalog.registry import SQL, query
from tidewater.catalog.sqltext import LOG, text
from tidewater.functions.segment import segmenter, word_costs
from tidewater.functions.text import register_tokenizer
from tidewater.operators import logs
from tidewater.plans import warehouse
from tidewater.session import new_dir
from tidewater.sources import lines as src


def _page(name):
    return F.col("page")[name].alias(name)



@query(
    "json_valid",
    f"WITH {LOG} SELECT seq, ts, mid, sid, is_new, item, {text('during_time')} AS during_time FROM log WHERE seq % 97 <> 0",
)
def json_valid(spark, sf):
    rows = src.app_log(fx.app_log_lines(spark, sf))
    return rows.select(
        "seq", "ts", "common.mid", "common.sid", "common.is_new", _page("item"), _page("during_time")
    )


@query("json_dead_letter", "SELECT event_id AS seq FROM events WHERE event_id % 97 = 0")
def json_dead_letter(spark, sf):
    bad = logs.dead_letters(logs.parse_records(fx.app_log_lines(spark, sf)))
    return bad.select(F.regexp_extract("value", r'"seq":(\d+)$', 1).cast("bigint").alias("seq"))


@query("split_err", f"WITH {LOG} SELECT seq, mid, ts, {text('k')} AS code, item_type FROM log WHERE event_type = 'error'")
def split_err(spark, sf):
    return logs.errors(fx.app_log(spark, sf)).select(
        "seq", "common.mid", "ts", F.col("err")["code"].alias("code"), _page("item_type")
    )


@query("split_start", f"WITH {LOG} SELECT seq, mid, ts, {text('k')} AS entry FROM log WHERE event_type = 'signup'")
def split_start(spark, sf):
    return logs.starts(fx.app_log(spark, sf)).select("seq", "common.mid", "ts", F.col("start")["entry"].alias("entry"))


def _items(df, column):
    item = F.col(column)
    return df.select("seq", "common.mid", "ts", item["item"].alias("item"), item["pos"].alias("pos"))


@query(
    "split_display",
    f"WITH {LOG} SELECT seq, mid, ts, 'd' || k AS item, {text('pos')} AS pos FROM log, range(1, 3) r(pos) WHERE pos <= n_displays",
)
def split_display(spark, sf):
    return _items(logs.displays(fx.app_log(spark, sf)), "display")


@query(
    "split_action",
    f"""WITH {LOG} SELECT seq, mid, CAST(NULL AS BIGINT) AS ts, 'a' || k AS item, {text('pos')} AS pos
FROM log, range(1, 3) r(pos) WHERE pos <= n_actions""",
)
def split_action(spark, sf):
    return _items(logs.actions(fx.app_log(spark, sf)), "action")


@query(
    "split_page",
    f"WITH {LOG} SELECT seq, mid, ts, item, last_page_id, item_type FROM log WHERE event_type <> 'signup'",
)
def split_page(spark, sf):
    return logs.pages(fx.app_log(spark, sf)).select(
        "seq", "common.mid", "ts", *[_page(c) for c in ("item", "last_page_id", "item_type")]
    )


# The JSON text of every output, fields in the order of their names where a record goes on as it was.
PAYLOADS = """
parts AS (
  SELECT *, '{"ar":"' || ar || '","ch":"' || ch || '","is_new":"' || flag || '","mid":"' || mid || '","sid":"' || sid
      || '","uid":' || mid || ',"vc":"' || vc || '"}' AS common,
    '{"during_time":' || coalesce('"' || during_time || '"', 'null') || ',"item":' || coalesce('"' || item || '"', 'null')
      || ',"item_type":"' || item_type || '","last_page_id":"' || last_page_id || '"}' AS page,
    ',"trace":{"path":[' || seq || ',' || mid || '],"sampled":true},"ts":' || ts || '}' AS rest
  FROM fixed
),
heads AS (SELECT *, '{"common":' || common AS head, ',"page":' || page AS paged, ',"seq":' || seq AS numbered FROM parts)
SELECT 'err' AS route, head || ',"err":{"code":"' || k || '"}' || paged || numbered || rest AS value
  FROM heads WHERE event_type = 'error'
UNION ALL SELECT 'start', head || paged || numbered || ',"start":{"entry":"' || k || '"}' || rest
  FROM heads WHERE event_type = 'signup'
UNION ALL SELECT 'display', head || paged || ',"display":{"item":"d' || k || '","pos":"' || pos || '"},"ts":' || ts || '}'
  FROM heads, range(1, 3) r(pos) WHERE pos <= n_displays
UNION ALL SELECT 'action', head || paged || ',"action":{"item":"a' || k || '","pos":"' || pos || '"}}'
  FROM heads, range(1, 3) r(pos) WHERE pos <= n_actions
UNION ALL SELECT 'page', head || paged || numbered || rest FROM heads WHERE event_type <> 'signup'
UNION ALL SELECT 'dirty', CAST(seq AS VARCHAR) FROM log WHERE seq % 97 = 0"""


def routed(rows):
    """The outputs; of a broken line its number, which ends it."""
    number = F.regexp_extract("value", r'"seq":(\d+)$', 1)
    return rows.select("route", F.when(F.col("route") == "dirty", number).otherwise(F.col("value")).alias("value"))


@query(
    "log_routes",
    f"""
WITH {LOG}, good AS (SELECT * FROM log WHERE seq % 97 <> 0),
first AS (
  SELECT DISTINCT mid, first_value(is_new) OVER w AS new0,
    CAST(first_value(et) OVER w AS DATE) AS day0
  FROM good WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)
),
fixed AS (
  SELECT good.*, CASE WHEN is_new = '1' AND CAST(et AS DATE) <> CASE WHEN new0 = '1' THEN day0 ELSE day0 - 1 END
    THEN '0' ELSE is_new END AS flag
  FROM good JOIN first USING (mid)
),
{PAYLOADS}
""",
)
def log_routes(spark, sf):
    path = new_dir(spark, "log-routes")
    warehouse.write_log(fx.app_log_lines(spark, sf), path, new_dir(spark, "log-staging"))
    return routed(spark.read.schema("value string, route string").parquet(path))


@query(
    "keyword_tokens",
    r"""
SELECT doc_id, keyword, count(*) AS n
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[\p{P}\p{S}\s]+')) AS keyword FROM documents)
WHERE keyword <> '' GROUP BY doc_id, keyword
""",
)
def keyword_tokens(spark, sf):
    register_tokenizer(spark)
    fx.spread(spark, sf, "documents", "doc_id").createOrReplaceTempView("token_documents")
    return spark.sql(
        "SELECT doc_id, keyword, count(*) AS n FROM token_documents, LATERAL tokenization(text) GROUP BY doc_id, keyword"
    )


@query(
    "keyword_window",
    f"""
WITH {LOG}, words AS (
  SELECT date_trunc('hour', et) AS h, unnest(string_split(item, ' ')) AS keyword FROM log
  WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL AND event_type <> 'signup'
)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS stt, strftime(h + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS edt,
  strftime(h, '%Y-%m-%d') AS cur_date, keyword, count(*) AS keyword_count
FROM words GROUP BY h, keyword
""",
)
def keyword_window(spark, sf):
    return warehouse.keyword_summary(fx.app_log(spark, sf), "1 hour")


@query("keyword_window_segmented", SQL["keyword_window"])
def keyword_window_segmented(spark, sf):
    """The search texts come without blanks; their words are found again by what part names teach."""
    log = fx.app_log(spark, sf)
    joined = log.withColumn("page", F.transform_values("page", lambda k, v: F.when(k == "item", F.replace(v, F.lit(" "), F.lit(""))).otherwise(v)))
    model = word_costs(fx.table(spark, sf, "part"), F.col("p_name"))
    return warehouse.keyword_summary(joined, "1 hour", segmenter(model))


@query("segment_names", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words FROM part")
def segment_names(spark, sf):
    part = fx.table(spark, sf, "part")
    words = segmenter(word_costs(part, F.col("p_name")))(F.replace("p_name", F.lit(" "), F.lit("")))
    return part.select("p_partkey", words.alias("words")).select("p_partkey", F.get("words", 0).alias("first_word"), F.size("words").alias("n_words"))


@query("segment_documents")
def segment_documents(spark, sf):
    """Every document without its blanks, cut into words by the frequencies of all documents."""
    docs = fx.table(spark, sf, "documents")
    words = segmenter(word_costs(docs, F.col("text")))(F.regexp_replace("text", r"\s+", ""))
    found = docs.select("doc_id", words.alias("words"))
    return found.select("doc_id", F.size("words").alias("n_words"), F.sha2(F.array_join("words", " "), 256).alias("words_sha256"))
