"""Streaming trade queries: rows arrive in parts, with one run of the query after each."""

from __future__ import annotations

import datetime
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tidemart.bindings import frames
from tidemart.bindings.registry import CATALOG, CATALOG_COLUMNS, DETAILS, LATEST, query, span, text
from tidemart.bindings.streams import Slices, _appended, _run
from tidemart.bindings.trade import (_ORDER_WINDOW, CART, MONTH, PAYMENTS, PROVINCES, REFUNDS, WEEK, WIDE,
                                     _latest, _payments, _refunds, _wide)
from tidemart.operators.changelog import flatten_envelopes
from tidemart.plans import trade
from tidemart.schemas import TABLE_CONFIG
from tidemart.session import shared_dir
from tidemart.sinks import BATCH, append_batches, read_upserted, tables, upsert_batches
from tidemart.sources import handed_over, with_snapshot
from tidemart.streaming import jobs, state
from tidemart.streaming.lookups import table_reader

CUT = "1998-06-01"
HALF = "pmod(xxhash64(id), 2) = 0"


@query("stream_cart_delta", "WITH " + CART + f"""
SELECT id, user_id, sku_id, source_type_code,
       CASE WHEN n_regionkey <= 2 OR l_shipdate >= DATE '{CUT}' THEN n_name END AS source_type_name, sku_num,
       CAST(epoch_us(l_shipdate) // 1000000 AS VARCHAR) AS ts
FROM cart LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = source_type_code""")
def stream_cart_delta(t):
    """Additions to carts; two fifths of the dictionary come between two micro-batches and name
    what is read after that, and no more."""
    base = shared_dir(t.spark, "cart")
    names = frames.dictionary(t)
    early = F.col("parent_code") <= "2"
    names.where(early).write.parquet(f"{base}/dictionary")
    before = F.col("ts").cast("bigint") < F.unix_timestamp(F.lit(CUT), "yyyy-MM-dd")
    sliced = Slices(t, frames.cart_changes(t), before, ~before)

    def arrivals() -> Iterator[None]:
        for n, _ in enumerate(sliced.grow()):
            if n == 1:
                names.where(~early).write.mode("append").parquet(f"{base}/dictionary")
            yield
    write = jobs.cart_detail_batches(table_reader(f"{base}/dictionary", names.schema), append_batches(f"{base}/table"))
    _run(t, sliced.stream, write, base, arrivals())
    return t.spark.read.parquet(f"{base}/table").drop(BATCH)


def _dictionary(t):
    """The code dictionary, read anew at each call."""
    return lambda spark: frames.dictionary(frames.Tables(spark, t.folder))


@query("stream_payment_detail", "WITH " + PAYMENTS + " SELECT * FROM payments")
def stream_payment_detail(t):
    """Paid order details; half of the details come before the payments, half after."""
    base = shared_dir(t.spark, "payment")
    details = Slices(t, trade.order_detail(_wide(t)).select(*trade.PAID_COLUMNS), F.expr(HALF), F.lit(False), ~F.expr(HALF))
    paid = Slices(t, frames.payment_changes(t), F.lit(False), F.lit(True), F.lit(False))
    write = jobs.payment_detail_batches(_dictionary(t), append_batches(f"{base}/table"))
    _run(t, jobs.payment_detail(paid.stream, details.stream), write, base, zip(details.grow(), paid.grow()), clock=True)
    return t.spark.read.parquet(f"{base}/table").drop(BATCH)


@query("stream_refund_detail", "WITH " + REFUNDS + """
SELECT * EXCLUDE (l_shipdate) FROM refunds
QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, province_id NULLS LAST) = 1""")
def stream_refund_detail(t):
    """Refund requests; half of them come before their order is marked refunded, half after."""
    base = shared_dir(t.spark, "refund")
    log = frames.union(frames.refund_changes(t), frames.order_changes(t))
    asked, half = F.col("table") == "order_refund_info", F.pmod(F.xxhash64(F.col("data")["id"]), F.lit(2)) == 0
    sliced = Slices(t, log, asked & half, ~asked, asked & ~half)
    _run(t, jobs.refund_detail(sliced.stream), jobs.refund_detail_batches(_dictionary(t), f"{base}/table"), base,
         sliced.grow(), clock=True)
    return jobs.read_refunds(t.spark, f"{base}/table")


def _by_time(t, rows: DataFrame, column: str) -> Slices:
    """Thirds by a text time."""
    return Slices(t, rows, F.col(column) < "1997-06-01", F.col(column).between("1997-06-01", "1999-06-01"),
                  F.col(column) > "1999-06-01")


@query("stream_province_window", "WITH " + PROVINCES + " SELECT * FROM province_orders")
def stream_province_window(t):
    """Orders and sales per week and province; an order counts where its first detail is, which
    may have come in an earlier micro-batch."""
    base = shared_dir(t.spark, "province")
    sliced = _by_time(t, _latest(t), "detail_create_time")
    write = jobs.province_batches(lambda spark: frames.provinces(frames.Tables(spark, t.folder)), f"{base}/table")
    _run(t, jobs.province_window(sliced.stream, "7 days"), write, base, sliced.grow(), "update", clock=True)
    return read_upserted(t.spark, f"{base}/table", ["stt", "province_id"], ["ts"]).drop("ts")


@query("stream_spu_window", "WITH " + LATEST + "," + CATALOG + f"""
SELECT {span('t', MONTH)}, {CATALOG_COLUMNS}, user_id, spu_id, spu_name,
       count(DISTINCT id) AS order_count, CAST(sum(total) AS DOUBLE) AS order_amount
FROM latest JOIN catalog USING (sku_id) GROUP BY ALL""")
def stream_spu_window(t):
    """Orders and sales per month, brand, categories, user and product; of the versions of a
    detail, which come in two micro-batches, the last one counts."""
    base = shared_dir(t.spark, "spu")
    details = frames.details(t)
    rows = details.withColumns({c: -F.col(c) for c in frames.VERSION_TIES})  # of equal times, the smallest
    version = ["row_op_ts", *frames.VERSION_TIES]
    end = rows.limit(1).withColumn("id", F.lit("end"))
    half = F.pmod(F.xxhash64(*version), F.lit(2)) == 0
    wait_ms, closing = 3_000, F.col("id") == "end"
    sliced = Slices(t, rows.unionByName(end), half & ~closing, ~half & ~closing, closing)

    def arrivals() -> Iterator[None]:
        for n, _ in enumerate(sliced.grow()):
            if n == 2:
                time.sleep(wait_ms / 1000)
            yield
    keys = ["stt", "user_id", "sku_id"]
    totals = jobs.sku_window(sliced.stream, "30 days", "3000 days", version, wait_ms)
    _run(t, totals, upsert_batches(f"{base}/table", keys), base, arrivals(), "update", clock=True)
    return trade.spu_rows(read_upserted(t.spark, f"{base}/table", keys), frames.catalog(t))


@query("stream_refund_window", "WITH " + REFUNDS + "," + CATALOG + f""",
once AS (SELECT * FROM refunds QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts, create_time, refund_amount) = 1),
totals AS (SELECT {span('l_shipdate', MONTH)}, user_id, sku_id, count(*) AS refund_count
           FROM once GROUP BY stt, edt, user_id, sku_id)
SELECT stt, edt, {CATALOG_COLUMNS}, user_id, refund_count FROM totals JOIN catalog USING (sku_id)""")
def stream_refund_window(t):
    """Refund requests per month, user and sku; what has come before comes again in the second
    micro-batch and does not count twice."""
    base = shared_dir(t.spark, "refund-window")
    refunds = _refunds(t).select("id", "user_id", "sku_id", "create_time", "refund_amount", "row_op_ts")
    sliced = Slices(t, refunds, F.col("create_time") < CUT, F.lit(True))
    write = jobs.refund_batches(lambda spark: frames.catalog(frames.Tables(spark, t.folder)), f"{base}/table")
    _run(t, jobs.refund_window(sliced.stream, "30 days", ties=["create_time", "refund_amount"]), write, base,
         sliced.grow(), "update", clock=True)
    return read_upserted(t.spark, f"{base}/table", ["stt", "user_id", "sku_id"], ["ts"]).drop("sku_id", "ts")


def _thirds(t, rows: DataFrame, name: str, totals, keys: list[str], column: str = "detail_create_time") -> DataFrame:
    """Run a window job in update mode over thirds by time and read its table."""
    base, sliced = shared_dir(t.spark, name), _by_time(t, rows, column)
    _run(t, totals(sliced.stream), upsert_batches(f"{base}/table", keys), base, sliced.grow(), "update")
    return read_upserted(t.spark, f"{base}/table", keys)


@query("stream_cart_window", "WITH " + CART + f""",
d AS (SELECT DISTINCT user_id, l_shipdate AS t FROM cart)
SELECT {span('t', WEEK)}, count(*) AS cart_add_uu_ct FROM d GROUP BY stt, edt""")
def stream_cart_window(t):
    """Daily cart users per week: state and window in one query."""
    carts = trade.cart_add(frames.cart_changes(t), frames.dictionary(t)).withColumn(
        "at", F.date_format(F.timestamp_seconds(F.col("ts").cast("bigint")), "yyyy-MM-dd HH:mm:ss"))
    return _thirds(t, carts, "cart-window", lambda s: jobs.cart_window(s, "7 days"), ["stt"], "at")


@query("stream_payment_window", "WITH " + PAYMENTS + f""",
d AS (SELECT user_id, left(callback_time, 10) AS day, min(make_timestamp(CAST(ts AS BIGINT) * 1000000)) AS t
      FROM payments GROUP BY ALL),
m AS (SELECT *, day = min(day) OVER (PARTITION BY user_id) AS is_first FROM d)
SELECT {span('t', WEEK)}, count(*) AS payment_suc_unique_user_count,
       count(*) FILTER (is_first) AS payment_suc_new_user_count FROM m GROUP BY stt, edt""")
def stream_payment_window(t):
    """Paying users and first-time payers per week, by what state knows of them."""
    return _thirds(t, _payments(t).select("user_id", "callback_time", "ts"), "payment-window",
                   lambda s: jobs.payment_window(s, "7 days"), ["stt"], "callback_time")


@query("stream_order_window", "WITH " + _ORDER_WINDOW + f"""
SELECT {span('t', WEEK)}, count(*) AS order_unique_user_count,
       count(*) FILTER (is_first) AS order_new_user_count,
       CAST(sum(coalesce(activity, 0)) AS DOUBLE) AS order_activity_reduce_amount,
       CAST(sum(coupon) AS DOUBLE) AS order_coupon_reduce_amount,
       CAST(sum(price) AS DOUBLE) AS order_original_total_amount
FROM marked GROUP BY stt, edt""")
def stream_order_window(t):
    """Ordering users, new ones, and the amounts of their first detail of the day, from state."""
    return _thirds(t, _latest(t), "order-window", lambda s: jobs.order_window(s, "7 days"), ["stt"])


@query("stream_latest_by_key", "WITH " + LATEST + f"""
SELECT id, sku_id, user_id, {text('t')} AS detail_create_time, CAST(total AS VARCHAR) AS split_total_amount FROM latest""")
def stream_latest_by_key(t):
    """The last version of each order detail, a fixed time after its first one came."""
    rows = frames.details(t).withColumns({c: -F.col(c) for c in frames.VERSION_TIES})
    version, wait_ms = ["row_op_ts", *frames.VERSION_TIES], 3_000
    end = rows.limit(1).withColumn("id", F.lit("end"))
    half, closing = F.pmod(F.xxhash64(*version), F.lit(2)) == 0, F.col("id") == "end"
    sliced = Slices(t, rows.unionByName(end), half & ~closing, ~half & ~closing, closing)

    def arrivals() -> Iterator[None]:
        for n, _ in enumerate(sliced.grow()):
            if n == 2:
                time.sleep(wait_ms / 1000)
            yield
    latest = state.latest_after_delay(sliced.stream, "id", version, wait_ms)
    return _appended(t, latest, "latest", arrivals(), clock=True).select(
        "id", "sku_id", "user_id", "detail_create_time", "split_total_amount")


@query("stream_earliest_by_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def stream_earliest_by_key(t):
    """The first version of each line; later ones are left out as long as state knows the line."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *frames.VERSION_TIES, "l_shipdate")
    early = F.col("l_shipdate") < F.lit(CUT).cast("timestamp")
    sliced = Slices(t, rows, early, ~early)
    first = state.first_seen(sliced.stream, ["l_orderkey", "l_linenumber"], "l_shipdate", frames.VERSION_TIES, only=True)
    return _appended(t, first, "earliest", sliced.grow(), clock=True).drop("l_shipdate")


WIDE_VERSION = ["row_op_ts", "type", "activity_id", "coupon_id", "split_total_amount", "detail_create_time",
                "activity_create_time", "coupon_create_time", "source_type"]
LAST_WIDE = """
QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, type DESC NULLS LAST, activity_id DESC NULLS LAST,
  coupon_id DESC NULLS LAST, split_total_amount DESC, detail_create_time DESC, activity_create_time DESC NULLS LAST,
  coupon_create_time DESC NULLS LAST, source_type DESC) = 1"""


def _wide_stream(t) -> str:
    """Folder of the wide table, after details, orders and their extras came one after another."""
    base = shared_dir(t.spark, "wide")
    table = F.col("table")
    sliced = Slices(t, frames.order_log(t).withColumn("database", F.lit("shop")), table == "order_detail", table == "order_info",
                    ~table.isin("order_detail", "order_info"))
    write = jobs.order_wide_batches(base, _dictionary(t))
    _run(t, jobs.order_facts(sliced.stream), write, base, sliced.grow())
    return base


@query("stream_order_wide", "WITH " + WIDE + " SELECT * FROM wide" + LAST_WIDE)
def stream_order_wide(t):
    """Line items with order, activity, coupon and source name; what comes late changes rows that
    were written before."""
    base = _wide_stream(t)
    return read_upserted(t.spark, f"{base}/wide", ["id"], WIDE_VERSION).drop("old")


@query("stream_order_detail", "WITH " + WIDE + ", last AS (SELECT * FROM wide" + LAST_WIDE + """)
SELECT * EXCLUDE (type) FROM last WHERE type = 'insert'""")
def stream_order_detail(t):
    """The wide rows of newly placed orders, by a stream that reads what the one before wrote."""
    base, out = _wide_stream(t), shared_dir(t.spark, "order-detail")
    schema = t.spark.read.option("basePath", f"{base}/wide").parquet(f"{base}/wide").schema
    stream = t.spark.readStream.schema(schema).option("basePath", f"{base}/wide").parquet(f"{base}/wide")
    version = [c for c in WIDE_VERSION if c != "type"]
    rows = trade.order_detail(stream).drop(BATCH)
    _run(t, rows, tables.keyed_table_batches(f"{out}/table", ["id"], version, 16), out)
    return tables.read_table(t.spark, f"{out}/table")


SNAPSHOT_AT = "1998-06-01"


@query("stream_keyed_upsert", "WITH " + DETAILS + f""", latest AS (
  SELECT * FROM details QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY t DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1)
SELECT id, sku_id, user_id, {text('t')} AS detail_create_time FROM latest""")
def stream_keyed_upsert(t):
    """Order details that arrive in four parts, in a table of which each micro-batch writes the
    partitions that it touches; the last micro-batch is written twice."""
    base = shared_dir(t.spark, "upsert-table")
    version = ["row_op_ts", *frames.VERSION_TIES]
    quarter = F.pmod(F.xxhash64(*version), F.lit(4))
    sliced = Slices(t, frames.details(t), *[quarter == n for n in range(4)])
    write = tables.keyed_table_batches(f"{base}/table", ["id"], version, 16)
    last = []

    def twice(df: DataFrame, batch: int) -> None:
        write(df, batch)
        last[:] = [batch]
    _run(t, sliced.stream, twice, base, sliced.grow())
    write(sliced.rows.where(quarter == 3), last[0])
    return tables.read_table(t.spark, f"{base}/table").select("id", "sku_id", "user_id", "detail_create_time")


@query("stream_dim_upsert", f"""
WITH last_line AS (
  SELECT l_partkey, l_returnflag FROM lineitem WHERE l_shipdate > DATE '{SNAPSHOT_AT}'
  QUALIFY row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag DESC) = 1)
SELECT CAST(coalesce(p_partkey, l_partkey) AS VARCHAR) AS p_partkey, p_brand, coalesce(l_returnflag, p_type) AS p_type
FROM (SELECT * FROM part WHERE p_size <= 45) FULL JOIN last_line ON p_partkey = l_partkey""")
def stream_dim_upsert(t):
    """A dimension from a snapshot and the change stream, which repeats what was changed before
    the snapshot."""
    base = shared_dir(t.spark, "dimension")
    at = F.unix_seconds("l_shipdate")
    changes = t.lineitem.select(
        F.create_map().cast("map<string,string>").alias("before"),
        F.create_map(F.lit("p_partkey"), F.col("l_partkey").cast("string"), F.lit("p_type"), F.col("l_returnflag")).alias("after"),
        F.struct(F.lit("part").alias("table")).alias("source"), F.lit("u").alias("op"), at.alias("position"),
        F.struct("l_orderkey", F.col("l_linenumber").cast("long").alias("n"), "l_suppkey",
                 F.col("l_extendedprice").cast("double").alias("p"), "l_returnflag").alias("place"))
    taken = int(datetime.datetime.fromisoformat(SNAPSHOT_AT).replace(tzinfo=datetime.UTC).timestamp())
    sliced = Slices(t, changes, F.col("position") <= taken + 40_000_000, F.col("position") > taken + 40_000_000)
    parts = t.part.where("p_size <= 45").select("p_partkey", "p_brand", "p_type")
    with_snapshot(t.spark, parts, "part", sliced.folder, "position", taken)
    version = ["position", "place"]
    log = flatten_envelopes(handed_over(sliced.stream, "position", taken), version)
    log = log.select("table", "type", F.col("after").alias("data"), *version)
    config = [("part", "dim_part", "p_partkey", "p_brand,p_partkey,p_type", "")]
    write = jobs.dimension_table_batches(
        f"{base}/tables", lambda spark: spark.createDataFrame(config, TABLE_CONFIG), version, 16)
    _run(t, log, write, base, sliced.grow())
    return jobs.read_dimension_table(t.spark, f"{base}/tables", "dim_part", "p_partkey,p_brand,p_type", "p_partkey")
