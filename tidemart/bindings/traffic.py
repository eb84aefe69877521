"""Traffic and user queries on events, keyword queries on documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.bindings import frames
from tidemart.bindings.registry import (DAILY_ENTRIES, ENTRIES, PAGES, bounces, query, span,
                                        start, text)
from tidemart.functions.tokens import SplitWords
from tidemart.operators import parse
from tidemart.operators.keyed import fix_is_new, toggle
from tidemart.plans import keywords, reports, traffic, users
from tidemart.session import stored

DAY, HALF_DAY = 86_400, 43_200
TIES = ["event_id"]

LOG_SQL = """
log AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ms, ts,
         CASE WHEN event_type <> 'error' THEN '1' ELSE '0' END AS flag,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
good AS (
  SELECT *, first_value(flag) OVER w AS flag0,
         CAST(make_timestamp_ms(first_value(ms) OVER w) AS DATE) AS day0
  FROM log WHERE NOT (event_type = 'error' AND k < 10)
  WINDOW w AS (PARTITION BY mid ORDER BY ms)),
fixed AS (
  SELECT *, CASE WHEN flag = '1' AND flag0 = '1' AND CAST(make_timestamp_ms(ms) AS DATE) = day0
                 THEN '1' ELSE '0' END AS is_new FROM good)"""


@query("log_parse_dirty", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'dirty' ELSE 'good' END AS route,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
FROM events""")
def log_parse_dirty(t):
    """JSON parsing with dead letters; the properties of error events lack their end."""
    whole = F.col("props")
    lines = t.events.select("event_id", F.when(
        F.col("event_type") == "error", F.left(whole, F.length(whole) - 1)).otherwise(whole).alias("value"))
    good, dirty = parse.split_valid(lines)
    return good.select("event_id", F.lit("good").alias("route"), parse.field("k", "int").alias("k")).unionByName(
        dirty.select("event_id", F.lit("dirty").alias("route"), F.lit(None).cast("int").alias("k")))


@query("page_log_json", """
SELECT CAST(user_id AS VARCHAR) AS mid, event_type AS page_id, epoch_us(ts) // 1000 AS ts,
       strftime(make_timestamp_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') AS event_time
FROM events WHERE event_type <> 'signup' AND NOT (event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 10)""")
def page_log_json(t):
    """The raw log as typed page records; starts and broken lines are none."""
    log = parse.page_log(frames.log_lines(t))
    return log.select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts",
                      F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@query("change_log_json", """
SELECT 'shop' AS database, 'cart_info' AS "table", 'insert' AS type, CAST(epoch_us(l_shipdate) // 1000000 AS VARCHAR) AS ts,
       l_orderkey || '-' || l_linenumber AS id, CAST(l_partkey AS VARCHAR) AS sku_id, CAST(NULL AS VARCHAR) AS old_sku
FROM lineitem""")
def change_log_json(t):
    """JSON change records as a typed change log."""
    record = F.struct(
        F.lit("shop").alias("database"), F.lit("cart_info").alias("table"), F.lit("insert").alias("type"),
        F.unix_seconds("l_shipdate").cast("string").alias("ts"),
        F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_partkey").alias("sku_id")).alias("data"))
    log = parse.change_log(t.lineitem.select(F.to_json(record).alias("value")))
    return log.where("proc_time IS NOT NULL").select(
        "database", "table", "type", "ts", F.col("data")["id"].alias("id"), F.col("data")["sku_id"].alias("sku_id"),
        F.col("old")["sku_id"].alias("old_sku"))


LOG_ROUTE_SQL = f"""
WITH {LOG_SQL}
SELECT 'start' AS route, NULL AS mid, NULL AS is_new, NULL AS page, CAST(k AS VARCHAR) AS item, NULL AS ms
FROM fixed WHERE event_type = 'signup'
UNION ALL SELECT 'page', mid, is_new, event_type, NULL, ms FROM fixed WHERE event_type <> 'signup'
UNION ALL SELECT 'error', mid, is_new, event_type, 'code ' || k, ms FROM fixed WHERE event_type = 'error'
UNION ALL SELECT 'display', NULL, NULL, event_type, CAST(k AS VARCHAR), ms FROM fixed WHERE event_type = 'view'
UNION ALL SELECT 'display', NULL, NULL, event_type, CAST(k + 1 AS VARCHAR), ms FROM fixed WHERE event_type = 'view'
UNION ALL SELECT 'action', NULL, NULL, event_type, CAST(k AS VARCHAR), ms FROM fixed WHERE event_type = 'click'
UNION ALL SELECT 'dirty', NULL, NULL, NULL, NULL, NULL FROM log WHERE event_type = 'error' AND k < 10
"""


@query("log_route", LOG_ROUTE_SQL)
def log_route(t):
    """The whole log split: six routes out of one log, read back from their JSON."""
    return route_fields(traffic.split_log(frames.log_lines(t), lambda df: stored(df, "log")))


def route_fields(routed):
    """Fields of the routed JSON records."""
    def at(path):
        return F.get_json_object("value", f"$.{path}")

    none = F.lit(None).cast("string")
    paths = {
        "start": (none, none, none, at("loading_time"), none),
        "page": (at("common.mid"), at("common.is_new"), at("page.page_id"), none, at("ts")),
        "error": (at("common.mid"), at("common.is_new"), at("page.page_id"), at("error"), at("ts")),
        "display": (none, none, at("page"), at("item"), at("ts")),
        "action": (none, none, at("page"), at("item"), at("ts")),
        "dirty": (none, none, none, none, none)}
    shape = F.lit(None).cast("struct<mid:string,is_new:string,page:string,item:string,ms:string>")
    for name, columns in paths.items():
        named = [c.alias(n) for c, n in zip(columns, ("mid", "is_new", "page", "item", "ms"))]
        shape = F.when(F.col("route") == name, F.struct(*named)).otherwise(shape)
    return routed.select("route", shape.alias("r")).select(
        "route", "r.mid", "r.is_new", "r.page", "r.item", F.col("r.ms").cast("bigint").alias("ms"))


@query("log_explode", """
SELECT event_type AS page, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts, CAST(json_extract_string(props, '$.k') AS INTEGER) + n AS item
FROM events, (VALUES (0), (1)) AS v(n) WHERE event_type = 'view'""")
def log_explode(t):
    """Displays of page records, each with the page id and time of its record."""
    routed = parse.routes(parse.parsed(frames.log_lines(t)))
    return parse.route(routed, "display").select(
        F.get_json_object("value", "$.page").alias("page"),
        F.get_json_object("value", "$.ts").alias("ts"),
        F.get_json_object("value", "$.item").cast("int").alias("item"))


@query("is_new_fix", f"""
WITH {PAGES}, f AS (
  SELECT *, first_value(is_new) OVER w AS flag0, CAST(first_value(t) OVER w AS DATE) AS day0 FROM pages
  WINDOW w AS (PARTITION BY mid ORDER BY t, event_id))
SELECT event_id, mid, CASE WHEN is_new = '1' AND flag0 = '1' AND CAST(t AS DATE) = day0
                           THEN '1' ELSE '0' END AS is_new FROM f""")
def is_new_fix(t):
    """New-visitor flag held only on the visitor's first day."""
    rows = frames.pages(t).select("event_id", F.col("common.mid").alias("mid"),
                                  F.col("common.is_new").alias("is_new"), "event_time")
    return fix_is_new(rows, "mid", "is_new", "event_time", TIES).drop("event_time")


@query("uv_detail", f"""
WITH {DAILY_ENTRIES}
SELECT event_id, mid, {text('t')} AS at FROM uv""")
def uv_detail(t):
    """First entry page of each visitor per day."""
    return traffic.uv_detail(frames.pages(t), TIES).select(
        "event_id", F.col("common.mid").alias("mid"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("bounce_detail", f"""
WITH {PAGES}, {bounces(HALF_DAY)}
SELECT event_id, mid, {text('t')} AS at FROM uj""")
def bounce_detail(t):
    """Entry pages after which the visitor did nothing for half a day."""
    return traffic.bounce_detail(frames.pages(t), "12 hours", TIES).select(
        "event_id", F.col("common.mid").alias("mid"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


def page_views(t, size="1 day"):
    pages = frames.pages(t)
    return traffic.page_view_window(pages, traffic.uv_detail(pages, TIES),
                                    traffic.bounce_detail(pages, "12 hours", TIES), size)


PAGE_VIEWS = f"""{DAILY_ENTRIES}, {bounces(HALF_DAY)},
measures AS (
  SELECT t, vc, ch, ar, is_new, 0 AS uv, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS sv,
         1 AS pv, during_time AS dur, 0 AS uj FROM pages
  UNION ALL SELECT t, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uv
  UNION ALL SELECT t, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM uj),
views AS (
  SELECT {span('t', DAY)}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
         CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
         CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
  FROM measures GROUP BY ALL)"""


@query("page_view_window", f"WITH {PAGE_VIEWS} SELECT * FROM views")
def page_view_window(t):
    """Five traffic measures per day, version, channel, area and new-visitor flag."""
    return page_views(t)


@query("home_detail_window", f"""
WITH {PAGES}, d AS (
  SELECT mid, event_type, CAST(t AS DATE) AS day, min(t) AS t FROM pages
  WHERE event_type IN ('view', 'click') GROUP BY ALL)
SELECT {span('t', 3600)}, count(*) FILTER (event_type = 'view') AS home_uv_ct,
       count(*) FILTER (event_type = 'click') AS good_detail_uv_ct FROM d GROUP BY stt, edt""")
def home_detail_window(t):
    """Daily visitors of the home and the product page, per hour."""
    return traffic.home_detail_window(frames.pages(t), "1 hour")


@query("login_window", f"""
WITH {ENTRIES}, d AS (
  SELECT uid, CAST(t AS DATE) AS day, min(t) AS t FROM entries GROUP BY ALL),
g AS (SELECT *, day - lag(day) OVER (PARTITION BY uid ORDER BY day) AS gap FROM d)
SELECT {span('t', DAY)}, count(*) FILTER (gap > 3) AS back_ct, count(*) AS uu_ct
FROM g GROUP BY stt, edt""")
def login_window(t):
    """Daily logins, and among them users back after more than three days."""
    return users.login_window(frames.pages(t), "1 day", gap=3)


@query("register_detail", f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d') AS date_id,
       {text('ts')} AS create_time, CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS ts
FROM events WHERE event_type = 'signup'""")
def register_detail(t):
    """New users from the change log."""
    return users.register_detail(frames.user_changes(t))


@query("register_window", f"""
SELECT {span('ts', 3600)}, count(*) AS register_ct FROM events WHERE event_type = 'signup'
GROUP BY stt, edt""")
def register_window(t):
    """Registrations per hour."""
    return users.register_window(users.register_detail(frames.user_changes(t)), "1 hour")


def keyword_sql(rows: str) -> str:
    return f"""
WITH {PAGES}, texts AS ({rows}),
tokens AS (SELECT source, t, unnest(regexp_extract_all(lower(keyword), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM texts)
SELECT {span('t', DAY)}, source, keyword, count(*) AS keyword_count,
       CAST(epoch({start('t', DAY)}) AS BIGINT) AS ts
FROM tokens GROUP BY stt, edt, source, keyword, ts"""


def _document_texts(t):
    at = F.timestamp_seconds(F.col("doc_id") * 3600)
    return t.documents.select("source", F.col("text").alias("keyword"), at.alias("event_time"))


_DOCUMENTS = keyword_sql("SELECT source, text AS keyword, make_timestamp(doc_id * 3600000000) AS t FROM documents")


@query("keyword_window", _DOCUMENTS)
def keyword_window(t):
    """Word counts of all documents per day and source."""
    return keywords.keyword_totals(keywords.split_words(_document_texts(t)), "1 day")


@query("keyword_udtf", _DOCUMENTS)
def keyword_udtf(t):
    """The same count through the table function and a lateral join."""
    texts = _document_texts(t)
    split = texts.lateralJoin(SplitWords(F.col("keyword").outer())).drop("keyword")
    return keywords.keyword_totals(split, "1 day")


@query("keyword_search", keyword_sql(
    "SELECT 'search' AS source, 'Item ' || k || ' - ' || event_type AS keyword, t FROM pages WHERE event_type = 'click'"))
def keyword_search(t):
    """Words of the searches in the page log."""
    return keywords.keyword_window(frames.pages(t), "1 day")


@query("toggle_filter", """
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) % 2 = 1""")
def toggle_filter(t):
    """Every other event of a user and type."""
    return toggle(t.events, ["user_id", "event_type"], "ts", ["event_id"]).select(
        "event_id", "user_id", "event_type")


@query("toggle_characters", """
WITH c AS (SELECT event_id, ts, generate_subscripts(string_split(props, ''), 1) - 1 AS pos,
                  unnest(string_split(props, '')) AS character FROM events)
SELECT event_id, CAST(pos AS INTEGER) AS pos, character FROM c
QUALIFY row_number() OVER (PARTITION BY character ORDER BY ts, event_id, pos) % 2 = 1""")
def toggle_characters(t):
    """Text split to characters; each character passes on every odd occurrence."""
    chars = t.events.select("event_id", "ts", F.posexplode(F.split("props", "")).alias("pos", "character"))
    return toggle(chars, ["character"], "ts", ["event_id", "pos"]).select("event_id", "pos", "character")


@query("report_uv_channel", f"""
WITH {PAGE_VIEWS} SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv FROM views
WHERE stt LIKE '2024-01-15 %' GROUP BY ch ORDER BY uv DESC, ch""")
def report_uv_channel(t):
    """Visitors of a day per channel."""
    return reports.visitors_by_channel(page_views(t), 20240115)
