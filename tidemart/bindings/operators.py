"""Join, change-record, dimension, sliding-window and function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.bindings import frames
from tidemart.bindings.registry import query, span, text
from tidemart.functions import times
from tidemart.functions.money import line_amount
from tidemart.operators import changelog, joins
from tidemart.operators.keyed import latest_by_key
from tidemart.operators.sliding import distinct_exact, distinct_sketch
from tidemart.operators.windows import windowed
from tidemart.plans import dimensions
from tidemart.sources import space_records

HOUR, DAY = 3_600, 86_400


def _views(t):
    return t.events.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"),
        F.col("value").alias("view_value"))


def _clicks(t):
    return t.events.where("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"),
        F.col("value").alias("click_value"))


SIDES = """
v AS (SELECT user_id, event_id AS view_id, ts AS view_ts, value AS view_value FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, ts AS click_ts, value AS click_value FROM events WHERE event_type = 'click')"""


@query("interval_join", f"""
WITH {SIDES}
SELECT user_id, view_id, click_id FROM v JOIN c USING (user_id)
WHERE click_ts BETWEEN view_ts - INTERVAL 6 HOUR AND view_ts + INTERVAL 6 HOUR""")
def interval_join(t):
    """Views and clicks of a user within six hours of each other."""
    pairs = joins.interval_join(_views(t), _clicks(t), "user_id", "view_ts", "click_ts",
                                "-6 hours", "6 hours")
    return pairs.select("user_id", "view_id", "click_id")


@query("window_join", f"""
WITH {SIDES}
SELECT {span('view_ts', DAY)}, user_id, view_id, click_id FROM v JOIN c USING (user_id)
WHERE epoch_us(view_ts) // {DAY * 1_000_000} = epoch_us(click_ts) // {DAY * 1_000_000}""")
def window_join(t):
    """Views and clicks of a user on the same day."""
    pairs = joins.window_join(_views(t), _clicks(t), "user_id", "view_ts", "click_ts", "1 day")
    return pairs.select("stt", "edt", "user_id", "view_id", "click_id")


@query("window_cogroup", f"""
WITH {SIDES},
l AS (SELECT {span('view_ts', DAY)}, user_id, count(*) AS views, min(view_id) AS first_view FROM v GROUP BY ALL),
r AS (SELECT {span('click_ts', DAY)}, user_id, count(*) AS clicks, max(click_id) AS last_click FROM c GROUP BY ALL)
SELECT stt, edt, user_id, views, first_view, clicks, last_click FROM l FULL JOIN r USING (stt, edt, user_id)""")
def window_cogroup(t):
    """Views beside clicks, per user and day."""
    return joins.window_cogroup(
        _views(t), _clicks(t), "user_id", "view_ts", "click_ts",
        [F.count("*").alias("views"), F.min("view_id").alias("first_view")],
        [F.count("*").alias("clicks"), F.max("click_id").alias("last_click")], "1 day")


@query("unwindowed_left_join", """
SELECT o_orderkey, o_orderstatus, l_partkey, l_extendedprice FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def unwindowed_left_join(t):
    """Orders with their lines; orders without one are kept."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return joins.left_join(orders, lines, "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderstatus", "l_partkey", "l_extendedprice")


@query("two_input_join", f"""
WITH {SIDES},
last_view AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY view_ts DESC, view_id) = 1)
SELECT user_id, click_id, view_id FROM c LEFT JOIN last_view USING (user_id)""")
def two_input_join(t):
    """Every click with the last view of its user."""
    both = joins.latest_partner(_clicks(t), _views(t), "user_id", "view_ts", ["view_id"])
    return both.select("user_id", "click_id", "view_id")


@query("dictionary_lookup", """
SELECT o_orderkey, left(o_orderpriority, 1) AS code, a.n_name AS name, b.n_name AS customer_name
FROM orders LEFT JOIN nation a ON CAST(a.n_nationkey AS VARCHAR) = left(o_orderpriority, 1)
LEFT JOIN nation b ON CAST(b.n_nationkey AS VARCHAR) = CAST(o_custkey AS VARCHAR)""")
def dictionary_lookup(t):
    """Two codes of an order decoded with one dictionary."""
    codes = t.orders.select("o_orderkey", F.left("o_orderpriority", F.lit(1)).alias("code"),
                            F.col("o_custkey").cast("string").alias("customer"))
    dictionary = frames.dictionary(t)
    once = joins.decode(codes, dictionary, "code", "name")
    return joins.decode(once, dictionary, "customer", "customer_name").drop("customer")


@query("dimension_chain", """
SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey""")
def dimension_chain(t):
    """A chain of lookups: supplier, nation, region."""
    step = joins.lookup(t.supplier, t.nation, "s_nationkey", "n_nationkey",
                        {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    return joins.lookup(step, t.region, "n_regionkey", "r_regionkey", {"r_name": "r_name"}).select(
        "s_suppkey", "n_name", "r_name")


# Change records and dimension tables.

def _envelopes(t):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    op = (F.when(kind == "view", "r").when(kind == "click", "c").when(kind == "signup", "u")
           .when(kind == "purchase", "d").otherwise("x"))
    image = F.create_map(F.lit("id"), F.col("event_id").cast("string"), F.lit("k"), k)
    return t.events.select("event_id", image.alias("before"), image.alias("after"),
                           F.struct(kind.alias("table")).alias("source"), op.alias("op"))


@query("cdc_flatten", """
WITH e AS (SELECT event_type AS "table", event_id, json_extract_string(props, '$.k') AS k,
                  CASE event_type WHEN 'view' THEN 'bootstrap-insert' WHEN 'click' THEN 'insert'
                       WHEN 'signup' THEN 'update' WHEN 'purchase' THEN 'delete' END AS type FROM events)
SELECT event_id, type, "table", CASE WHEN type IN ('update', 'delete') THEN k END AS before_k,
       CASE WHEN type IN ('bootstrap-insert', 'insert', 'update') THEN k END AS after_k,
       CASE WHEN type IN ('update', 'delete') THEN 2 ELSE 0 END AS before_size FROM e""")
def cdc_flatten(t):
    """Capture envelopes made flat."""
    flat = changelog.flatten_envelopes(_envelopes(t), keep=["event_id"])
    return flat.select("event_id", "type", "table", F.col("before")["k"].alias("before_k"),
                       F.col("after")["k"].alias("after_k"), F.size("before").alias("before_size"))


@query("update_transition", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id FROM orders WHERE o_orderstatus = 'F'""")
def update_transition(t):
    """Orders whose status was changed to refunded."""
    return frames.order_changes(t).where(changelog.changed_to("order_status", "1005")).select(
        F.col("data")["id"].alias("order_id"))


def _dimension_log(t):
    """Changes of parts, suppliers and nations, the last of which no dimension is made of."""
    def image(df, table, kind, version):
        data = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
        return df.select(F.lit(table).alias("table"), kind.alias("type"), data.alias("data"),
                         version.alias("version"))
    size = F.col("p_size")
    kind = F.when(size > 45, "delete").when(size <= 10, "bootstrap-insert").otherwise("update")
    zero = F.lit(0).cast("bigint")
    return (image(t.part, "part", kind, zero)
            .unionByName(image(t.supplier, "supplier", F.lit("insert"), zero))
            .unionByName(image(t.nation, "nation", F.lit("insert"), zero)))


def _config(t):
    """Table configuration: two dimension tables, given as capture envelopes."""
    def envelope(version, op, **row):
        fields = [x for k, v in row.items() for x in (F.lit(k), F.lit(v))]
        image = F.create_map(*fields)
        empty = F.create_map().cast(schemas.STRINGS)
        return t.region.where("r_regionkey = 0").select(
            F.lit(version).alias("version"), empty.alias("before"),
            (empty if op == "d" else image).alias("after"),
            F.struct(F.lit("table_process").alias("table")).alias("source"), F.lit(op).alias("op"))
    return (envelope(1, "r", source_table="part", sink_table="dim_part", sink_pk="p_partkey",
                     sink_columns="p_partkey,p_brand")
            .unionByName(envelope(2, "u", source_table="part", sink_table="dim_part",
                                  sink_pk="p_partkey", sink_columns="p_partkey,p_brand,p_type"))
            .unionByName(envelope(3, "c", source_table="supplier", sink_table="dim_supplier",
                                  sink_pk="s_suppkey", sink_columns="s_suppkey,s_name"))
            .unionByName(envelope(4, "d", source_table="supplier")))


@query("dim_route", """
SELECT 'part' AS "table", CASE WHEN p_size <= 10 THEN 'bootstrap-insert' ELSE 'update' END AS type,
       'dim_part' AS sink_table, 'p_partkey' AS sink_pk,
       'p_brand=' || p_brand || ';p_partkey=' || p_partkey || ';p_type=' || p_type AS fields
FROM part WHERE p_size <= 45
UNION ALL SELECT 'supplier', 'insert', 'dim_supplier', 's_suppkey',
       's_name=' || s_name || ';s_suppkey=' || s_suppkey FROM supplier""")
def dim_route(t):
    """Changes of configured tables with the configured columns only."""
    routed = dimensions.route_changes(_dimension_log(t), _config(t), ["version"])
    entries = F.array_sort(F.transform(F.map_entries("data"),
                                       lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return routed.select("table", "type", "sink_table", "sink_pk",
                         F.array_join(entries, ";").alias("fields"))


@query("dim_upsert", """
WITH last_line AS (
  SELECT l_partkey, l_returnflag FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag DESC) = 1)
SELECT CAST(coalesce(p_partkey, l_partkey) AS VARCHAR) AS p_partkey, p_brand, coalesce(l_returnflag, p_type) AS p_type
FROM (SELECT * FROM part WHERE p_size <= 45) FULL JOIN last_line ON p_partkey = l_partkey""")
def dim_upsert(t):
    """A dimension after its snapshot and later updates of a single column."""
    zero = F.lit(0).cast("bigint")
    snapshot = _dimension_log(t).withColumn(
        "version", F.struct(zero.alias("at"), zero.alias("o"), zero.alias("n"), zero.alias("s"),
                            F.lit(0.0).alias("p"), F.lit("").alias("f")))
    later = t.lineitem.select(
        F.lit("part").alias("table"), F.lit("update").alias("type"),
        F.create_map(F.lit("p_partkey"), F.col("l_partkey").cast("string"),
                     F.lit("p_type"), F.col("l_returnflag")).alias("data"),
        F.struct(F.unix_seconds("l_shipdate").alias("at"), F.col("l_orderkey").alias("o"),
                 F.col("l_linenumber").cast("bigint").alias("n"), F.col("l_suppkey").alias("s"),
                 F.col("l_extendedprice").alias("p"), F.col("l_returnflag").alias("f")).alias("version"))
    routed = dimensions.route_changes(snapshot.unionByName(later), _config(t), ["version"])
    return dimensions.dimension_table(routed, "dim_part", "p_partkey,p_brand,p_type",
                                      ["version"], "p_partkey")


# Windows.

@query("slide_distinct", f"""
WITH x AS (
  SELECT event_type, user_id,
         unnest(generate_series(0, 2)) * {2 * HOUR * 1_000_000} AS back, (epoch_us(ts) // {2 * HOUR * 1_000_000}) * {2 * HOUR * 1_000_000} AS pane
  FROM events)
SELECT {text('make_timestamp(pane - back)')} AS stt, {text(f'make_timestamp(pane - back + {6 * HOUR * 1_000_000})')} AS edt,
       event_type, count(DISTINCT user_id) AS ct FROM x GROUP BY ALL""")
def slide_distinct(t):
    """Distinct users per event type in a window of six hours that moves by two."""
    return distinct_exact(t.events, "ts", ["event_type"], "user_id", "6 hours", "2 hours")


SLIDES = f"""
WITH x AS (
  SELECT event_type, user_id,
         unnest(generate_series(0, 2)) * {2 * HOUR * 1_000_000} AS back, (epoch_us(ts) // {2 * HOUR * 1_000_000}) * {2 * HOUR * 1_000_000} AS pane
  FROM events)
SELECT {text('make_timestamp(pane - back)')} AS stt, {text(f'make_timestamp(pane - back + {6 * HOUR * 1_000_000})')} AS edt,
       event_type, count(DISTINCT user_id) AS ct, true AS close FROM x GROUP BY ALL"""


@query("slide_distinct_close", SLIDES)
def slide_distinct_close(t):
    """The exact count, and whether the estimate from sketches is within 5 % or one of it."""
    keys = ["stt", "edt", "event_type"]
    args = (t.events, "ts", ["event_type"], "user_id", "6 hours", "2 hours")
    about = distinct_sketch(*args).withColumnRenamed("ct", "about")
    off = F.abs(F.col("ct") - F.col("about"))
    return distinct_exact(*args).join(about, keys, "full").select(
        *keys, "ct", F.coalesce(off <= F.greatest(F.lit(1.0), 0.05 * F.col("ct")), F.lit(False)).alias("close"))


@query("slide_distinct_sketch")
def slide_distinct_sketch(t):
    """The same count, estimated from mergeable sketches."""
    return distinct_sketch(t.events, "ts", ["event_type"], "user_id", "6 hours", "2 hours")


@query("latest_window_count", f"""
WITH l AS (SELECT * FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1)
SELECT {span('ts', DAY)}, event_type, count(*) AS ct FROM l GROUP BY ALL""")
def latest_window_count(t):
    """Last events of each user and type, counted per day and type."""
    latest = latest_by_key(t.events, ["user_id", "event_type"], ["ts"], ["event_id"])
    return windowed(latest, "ts", "1 day", [F.count("*").alias("ct")], ["event_type"])


# Sources and functions.

@query("text_records", """
SELECT event_id AS some_id, event_type AS name, CAST(user_id AS VARCHAR) AS url, epoch_us(ts) // 1000 AS ts FROM events""")
def text_records(t):
    """Space-separated lines read back into typed columns."""
    lines = t.events.select(F.concat_ws(" ", "event_id", "event_type", "user_id",
                                        F.unix_millis("ts")).alias("value"))
    return space_records(lines, {"some_id": "bigint", "name": "string", "url": "string", "ts": "bigint"})


@query("time_functions", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_text,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) * 1000 AS date_ms,
       (epoch_us(ts) // 1000000) * 1000 AS datetime_ms,
       epoch_us(ts) // 10000 * 10 AS fraction_ms,
       date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days_since,
       strftime(ts, '%Y-%m-%d') AS day_part FROM events""")
def time_functions(t):
    """Dates and times to text, to epoch numbers and back."""
    ms = F.unix_millis("ts")
    shown = times.millis_datetime(ms)
    hundredths = F.lpad((F.pmod(ms, F.lit(1000)) / 10).cast("int").cast("string"), 2, "0")
    return t.events.select(
        "event_id", times.millis_date(ms).alias("date_text"), shown.alias("datetime_text"),
        times.date_millis(times.millis_date(ms)).alias("date_ms"),
        times.datetime_millis(shown).alias("datetime_ms"),
        F.unix_millis(times.fraction_time(F.concat(shown, F.lit("."), hundredths, F.lit("Z")))).alias("fraction_ms"),
        times.day_gap(F.col("ts"), F.lit("2024-01-01")).cast("bigint").alias("days_since"),
        times.day_text(shown).alias("day_part"))


@query("line_amount", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(28,2)) AS VARCHAR) AS amount
FROM lineitem""")
def line_amounts(t):
    """Price times piece count as text."""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             line_amount(F.col("l_extendedprice").cast("string"),
                                         F.col("l_quantity").cast("int").cast("string")).alias("amount"))
