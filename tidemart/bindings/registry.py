"""Named queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.bindings.frames import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return register


# Fragments of reference SQL.

def start(ts: str, seconds: int) -> str:
    """Start of the epoch-aligned window that holds a timestamp."""
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def span(ts: str, seconds: int) -> str:
    """``stt`` and ``edt`` of the window that holds a timestamp."""
    s = start(ts, seconds)
    return f"{text(s)} AS stt, {text(f'{s} + INTERVAL {seconds} SECOND')} AS edt"


PAGES = """
pages AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS mid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS uid,
         'v' || CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 50) AS INTEGER) AS vc,
         'ch' || CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 25) AS INTEGER) AS ch,
         CASE WHEN value > 50 THEN 'north' ELSE 'south' END AS ar,
         CASE WHEN event_type <> 'error' THEN '1' ELSE '0' END AS is_new,
         CAST(round(value * 100) AS BIGINT) AS during_time,
         make_timestamp_ms(epoch_us(ts) // 1000) AS t
  FROM events)"""

ENTRIES = PAGES + """,
entries AS (SELECT * FROM pages WHERE event_type = 'view')"""

DAILY_ENTRIES = ENTRIES + """,
uv AS (SELECT * FROM entries
       QUALIFY row_number() OVER (PARTITION BY mid, CAST(t AS DATE) ORDER BY t, event_id) = 1)"""


def bounces(within_seconds: int) -> str:
    return f"""
uj AS (
  SELECT * EXCLUDE (nt, ne) FROM (
    SELECT *, lead(t) OVER w AS nt, lead(event_type) OVER w AS ne FROM pages
    WINDOW w AS (PARTITION BY mid ORDER BY t, event_id))
  WHERE event_type = 'view'
    AND (nt IS NULL OR ne = 'view' OR nt - t >= INTERVAL {within_seconds} SECOND))"""


LINES = """
lines AS (
  SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS tax
  FROM lineitem)"""

ORDERS = """
shop_orders AS (
  SELECT o_orderkey, o_custkey, c_nationkey, o_orderstatus, o_orderdate, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

DETAILS = LINES + "," + ORDERS + """,
details AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(c_nationkey AS VARCHAR) AS province_id, l_shipdate AS t, price,
         price - discount AS total, CASE WHEN l_discount > 0 THEN discount END AS activity,
         tax AS coupon, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lines JOIN shop_orders ON l_orderkey = o_orderkey)"""

LATEST = DETAILS + """,
latest AS (
  SELECT * FROM details
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY t DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)"""

CATALOG = """
catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, 'spu' || p_size AS spu_id, 'Size ' || p_size AS spu_name,
         p_brand AS trademark_id, upper(p_brand) AS trademark_name,
         CAST(n_nationkey AS VARCHAR) AS category3_id, n_name AS category3_name,
         CAST(r_regionkey AS VARCHAR) AS category2_id, r_name AS category2_name,
         left(r_name, 1) AS category1_id, 'Group ' || left(r_name, 1) AS category1_name
  FROM part
  JOIN nation ON n_nationkey = CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 25
  JOIN region ON r_regionkey = n_regionkey)"""

CATALOG_COLUMNS = ("trademark_id, trademark_name, category1_id, category1_name, "
                   "category2_id, category2_name, category3_id, category3_name")
