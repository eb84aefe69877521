"""Streaming jobs: sources in, streaming frames or micro-batch writers out."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemart import fixed, schemas
from tidemart.functions.durations import micros
from tidemart.functions.money import money, total
from tidemart.functions.times import datetime_of, day_text, seconds_of
from tidemart.operators import dims, parse
from tidemart.operators.windows import bounds, windowed
from tidemart.plans import trade, traffic, users
from tidemart.session import COMPRESSION
from tidemart.sinks import BATCH, BatchWriter, read_upserted, tables, upsert_batches
from tidemart.streaming import state
from tidemart.streaming.lookups import Reader, enriched


_ONE_DAY = 86_400_000


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Run continuously every so often, or once over all that has arrived."""
    return (writer.trigger(processingTime=every) if every
            else writer.trigger(availableNow=True)).start()


# Traffic.

def split_log(lines: DataFrame) -> DataFrame:
    """``route, value`` of a stream of log lines; write it with ``partitionBy("route")``."""
    keyed = traffic.log_records(lines)
    usable = keyed.where("usable").drop("usable").withColumn("_day", F.to_date("event_time"))
    fixed_ = state.new_flag(usable, "mid", "event_time", "_day", "is_new", ["value"])
    dirty = keyed.where("not usable").select(F.lit("dirty").alias("route"), "value")
    return traffic.corrected_routes(fixed_.drop("_day")).unionByName(dirty)


def daily_first(df: DataFrame, keys: Sequence[str], ts: str, keep: str = "1 day") -> DataFrame:
    """First arriving row per key and day.

    Built in, without Python: keys are forgotten once the watermark is ``keep`` past
    them, and rows of one day lie less than a day apart.
    """
    dated = df.withColumn("_day", F.to_date(F.col(ts))).withWatermark(ts, keep)
    return dated.dropDuplicatesWithinWatermark([*keys, "_day"]).drop("_day")


def uv_detail(pages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """First entry page of each device and day.

    With ``ties`` it is the earliest of the micro-batch that brings the first one, and state lives
    for a day by the clock; without, any of them, in a built-in operator.
    """
    with_mid = traffic.entries(pages).withColumn("_mid", F.col("common.mid"))
    if not ties:
        return daily_first(with_mid, ["_mid"], "event_time").drop("_mid")
    dated = with_mid.withColumn("_day", F.to_date("event_time"))
    return state.first_seen(dated, ["_mid", "_day"], "event_time", ties, _ONE_DAY, only=True).drop("_mid", "_day")


def bounce_detail(pages: DataFrame, within: str = "10 seconds", delay: str = "2 seconds",
                  ties: Sequence[str] = ()) -> DataFrame:
    """Bounces.  Read the output with a delay of 12 seconds or more to window it."""
    rows = pages.withColumn("_mid", F.col("common.mid")).withColumn(
        "_entry", F.col("page.last_page_id").isNull())
    return state.bounces(rows, "_mid", "event_time", "_entry", micros(within) // 1000, delay,
                         ties).drop("_mid", "_entry")


def page_view_window(pages: DataFrame, uv: DataFrame, uj: DataFrame, size: str = "10 seconds",
                     delay: str = "12 seconds") -> DataFrame:
    """The three streams in one window.

    Each has a watermark of its own and the slowest counts for all, which is Spark's policy where
    none is set.  So a bounce, which comes out only after its visitor has been away for long
    enough, is in time however far the pages are ahead.
    """
    marked = [s.withWatermark("event_time", delay) for s in (pages, uv, uj)]
    return traffic.page_view_totals(traffic.page_view_measures(*marked), size)


def sliding_distinct(df: DataFrame, ts: str, keys: Sequence[str], value: str, size: str,
                     slide: str, delay: str = "0 seconds", rsd: float = 0.01) -> DataFrame:
    """Estimated distinct values per sliding window; the state is one sketch each."""
    span = F.window(ts, size, slide).alias("_span")
    counted = df.withWatermark(ts, delay).groupBy(span, *keys).agg(
        F.approx_count_distinct(value, rsd).alias("ct"))
    return bounds(counted, "_span")


# Users and trade.

def day_marks(df: DataFrame, keys: str | Sequence[str], ts: str, ties: Sequence[str] = (),
              gap: int = 7, delay: str | None = None, keep_ms: int | None = None) -> DataFrame:
    """First row of each key and day with ``day``, ``is_first_day`` and ``is_back``."""
    dated = df.withColumn("day", F.date_format(F.col(ts), fixed.DATE_FORMAT))
    return state.day_marks(dated, keys, ts, "day", ties, gap, delay, keep_ms)


def home_detail_window(pages: DataFrame, size: str = "3 seconds", delay: str = "1 second") -> DataFrame:
    two = traffic.home_and_detail(pages)
    firsts = day_marks(two, ["mid", "page_id"], "event_time", delay=delay, keep_ms=_ONE_DAY)
    return traffic.home_detail_totals(firsts, size)


def login_window(pages: DataFrame, size: str = "10 seconds", gap: int = 7,
                 delay: str = "2 seconds") -> DataFrame:
    marked = day_marks(users.logins(pages), "uid", "event_time", gap=gap, delay=delay)
    return users.login_totals(marked, size)


def register_window(registered: DataFrame, size: str = "10 seconds", delay: str = "1 second") -> DataFrame:
    timed = registered.withColumn("event_time", seconds_of(F.col("ts"))).withWatermark("event_time", delay)
    return users.register_totals(timed, size)


def cart_window(carts: DataFrame, size: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    marked = day_marks(trade.timed(carts), "user_id", "event_time", delay=delay, keep_ms=_ONE_DAY)
    return trade.cart_totals(marked, size)


def payment_window(payments: DataFrame, size: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    dated = trade.timed(payments, "callback_time").withColumn("day", day_text(F.col("callback_time")))
    marked = state.day_marks(dated, "user_id", "event_time", "day", delay=delay)
    return trade.payment_totals(marked, size)


def order_window(latest: DataFrame, size: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    """``latest`` is a stream of one row per detail, see ``state.latest_after_delay``."""
    marked = state.day_marks(trade.order_rows(latest), "user_id", "event_time", "date", ["id"], delay=delay)
    return trade.order_totals(marked.withColumn("unique", F.lit(1)).withColumnRenamed("is_first_day", "new"), size)


# Details that wait for another stream, and windows over what was seen first.  Names are looked up
# in the writer of the micro-batch, where a dimension is read anew.  The clock drives these jobs:
# start them with a processing-time trigger.

def cart_detail_batches(dictionary: Reader, write: BatchWriter) -> BatchWriter:
    """Writer of additions to carts for a change-log stream."""
    return enriched(write, trade.cart_add, dictionary)


def payment_detail(log: DataFrame, details: DataFrame, ttl_ms: int = _ONE_DAY, salts: int = 4) -> DataFrame:
    """Order details joined with their payments, whichever comes first; write them with
    :func:`payment_detail_batches`."""
    joined = state.pair_join(details.select(*trade.PAID_COLUMNS), trade.payments(log), "order_id", "_order",
                             ttl_ms, "inner", salts)
    return joined.drop("matched")


def payment_detail_batches(dictionary: Reader, write: BatchWriter) -> BatchWriter:
    return enriched(write, trade.payment_rows, dictionary)


def refund_detail(log: DataFrame, ttl_ms: int = _ONE_DAY, salts: int = 4) -> DataFrame:
    """Refund requests, at once without an order and again when that is marked refunded; write
    them with :func:`refund_detail_batches`."""
    return state.pair_join(trade.refund_requests(log), trade.refunded_orders(log), "order_id", "_order",
                           ttl_ms, "left", salts)


REFUND_VERSION = ("row_op_ts", "matched")


def refund_detail_batches(dictionary: Reader, path: str) -> BatchWriter:
    """Writer of an upserted table of refund details; :func:`read_refunds` gives it."""
    return enriched(upsert_batches(path, ["id"], REFUND_VERSION),
                    lambda df, names: trade.refund_rows(df, names, ["matched"]), dictionary)


def read_refunds(spark: SparkSession, path: str) -> DataFrame:
    return read_upserted(spark, path, ["id"], REFUND_VERSION).drop("matched")


def province_window(latest: DataFrame, size: str = "10 seconds", delay: str = "2 seconds",
                    ttl_ms: int = _ONE_DAY) -> DataFrame:
    """Orders and amount per province of a stream of one row per detail.

    An order counts with the first of its details that comes; after ``ttl_ms`` it is forgotten.
    Write it with :func:`province_batches`.
    """
    rows = latest.select("order_id", "province_id", datetime_of(F.col("detail_create_time")).alias("event_time"),
                         money(F.col("split_total_amount")).alias("amount")).where("event_time IS NOT NULL")
    rows = rows.withColumn("_place", F.coalesce("province_id", F.lit("")))
    flagged = state.first_seen(rows, ["order_id"], "event_time", ["_place"], ttl_ms).withWatermark("event_time", delay)
    return windowed(flagged, "event_time", size, [
        F.sum("is_first").alias("order_count"), total(F.col("amount")).alias("order_amount")], ["province_id"])


def province_batches(provinces: Reader, path: str) -> BatchWriter:
    """Upserted table by ``stt, province_id``, with the names of the time and the version ``ts``."""
    return enriched(upsert_batches(path, ["stt", "province_id"], stamp=True), trade.province_names, provinces)


def sku_window(details: DataFrame, size: str = "10 seconds", delay: str = "2 seconds",
               version: Sequence[str] = ("row_op_ts",), wait_ms: int = 5_000) -> DataFrame:
    """Details and amount per user and sku of a stream of versions of details.

    Each detail counts once, with the last version that comes within ``wait_ms`` of its first:
    state holds the distinct details ahead of the window.  Write it as an upserted table with keys
    ``stt, user_id, sku_id``; ``trade.spu_rows`` adds it up by brand, categories, user and product.
    """
    rows = details.select("id", "user_id", "sku_id", *version, datetime_of(F.col("detail_create_time")).alias("event_time"),
                          money(F.col("split_total_amount")).alias("amount")).where("event_time IS NOT NULL")
    latest = state.latest_after_delay(rows, "id", version, wait_ms).withWatermark("event_time", delay)
    return trade.sku_totals(latest, size)


def refund_window(refunds: DataFrame, size: str = "10 seconds", delay: str = "2 seconds",
                  ties: Sequence[str] = (), ttl_ms: int = _ONE_DAY) -> DataFrame:
    """Refund requests per user and sku, each request once; write it with :func:`refund_batches`."""
    once = state.first_seen(refunds, ["id"], "row_op_ts", ties, ttl_ms, only=True)
    rows = once.select("user_id", "sku_id", datetime_of(F.col("create_time")).alias("event_time"))
    return trade.refund_totals(rows.where("event_time IS NOT NULL").withWatermark("event_time", delay), size)


def refund_batches(catalog: Reader, path: str) -> BatchWriter:
    """Upserted table by ``stt, user_id, sku_id``, with the catalog of the time and the version ``ts``."""
    return enriched(upsert_batches(path, ["stt", "user_id", "sku_id"], stamp=True), trade.refund_names, catalog)


WIDE_SOURCES = (fixed.ORDER_DETAIL, fixed.ORDER_INFO, fixed.ORDER_DETAIL_ACTIVITY,
                fixed.ORDER_DETAIL_COUPON)


def order_facts(log: DataFrame) -> DataFrame:
    """Of a change-log stream, the rows behind each wide row that a micro-batch changes.

    A left join whose sides come in any order and change later cannot be one streaming
    join.  The sides are kept in state per order instead, with the fields that the wide row
    takes; write the result with :func:`order_wide_batches`, which joins it.
    """
    data, table = F.col("data"), F.col("table")
    child = (F.when(table == fixed.ORDER_INFO, F.lit(None))
              .when(table == fixed.ORDER_DETAIL, data["id"]).otherwise(data["order_detail_id"]))
    order = F.when(table == fixed.ORDER_INFO, data["id"]).otherwise(data["order_id"])
    rows = log.where(table.isin(*WIDE_SOURCES) & order.isNotNull())
    facts = state.touched_facts(rows.select(
        order.alias("order_key"), child.cast("string").alias("_child"), "table", "type", "ts",
        *[data[c].cast("string").alias(f"_{c}") for c in trade.WIDE_FIELDS], F.to_json("old").alias("old")), "order_key")
    image = F.struct(*[F.col(f"_{c}").alias(c) for c in trade.WIDE_FIELDS])
    return facts.select("order_key", "table", "type", "ts", image.alias("data"), F.from_json("old", schemas.STRINGS).alias("old"))


def order_wide_batches(base: str, dictionary: Callable[[SparkSession], DataFrame]) -> BatchWriter:
    """Micro-batch writer of the wide order table, for :func:`order_facts`.

    Adds the new versions of the changed rows to ``base``/wide; read it as an upserted
    table with key ``id`` and ``type`` and version ``row_op_ts``.  The facts are written
    first, because the join reads them four times; those of the micro-batch before are deleted.
    """
    def write(df: DataFrame, batch: int) -> None:
        facts = f"{base}/facts/{BATCH}={batch}"
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(facts)
        spark = df.sparkSession
        wide = trade.order_wide(spark.read.schema(df.schema).parquet(facts), dictionary(spark))
        wide.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{base}/wide/{BATCH}={batch}")
        tables.delete(spark, f"{base}/facts/{BATCH}={batch - 1}")  # it cannot be run again
    return write


def dimension_batches(base: str, config: Callable[[SparkSession], DataFrame]) -> BatchWriter:
    """Micro-batch writer of all dimension tables, for change-log rows.

    The configuration is read anew for each micro-batch, so a row added to it takes
    effect with the next one and its first rows need no restart.  Changes are written
    once, partitioned by target table; :func:`read_dimension` gives a table.
    """
    def write(df: DataFrame, batch: int) -> None:
        routed = dims.route(df, config(df.sparkSession))
        (routed.select("sink_table", "sink_pk", "type", "ts", "data")
               .write.mode("overwrite").partitionBy("sink_table").parquet(f"{base}/{BATCH}={batch}"))
    return write


def read_dimension(spark: SparkSession, base: str, sink_table: str, sink_columns: str,
                   sink_pk: str | None = None) -> DataFrame:
    """A dimension table as of the last micro-batch."""
    columns = dims.column_list(sink_columns, sink_pk)
    changes = spark.read.option("basePath", base).parquet(base)
    return dims.upserted(changes, sink_table, columns, columns[0],
                         [BATCH, F.col("ts").try_cast("bigint")])


def dimension_table_batches(base: str, config: Reader, version: Sequence[str] = ("ts",), parts: int = tables.PARTS,
                            stream: str = "main", catalog: bool = False) -> BatchWriter:
    """Micro-batch writer that keeps every dimension table up to date in place.

    The configuration is read anew for each micro-batch.  Its rows are counted and then gone
    through one by one, as they are few: a table is written for each that has changes.  With
    ``catalog`` the first row of a table also creates it in the catalog, columns that its
    configuration gains are added, and the partitions written are put into it.
    :func:`read_dimension_table` gives a table without the catalog.
    """
    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        setup = config(spark)
        if setup.limit(MOST_TABLES + 1).count() > MOST_TABLES:
            raise ValueError(f"more than {MOST_TABLES} dimension tables are configured")
        routed = dims.route(df, setup).select("sink_table", "sink_pk", "data", *version)
        path = f"{base}/_routed/{stream}/{BATCH}={batch}"
        routed.write.mode("overwrite").partitionBy("sink_table").parquet(path)
        changes = spark.read.schema(routed.schema).parquet(path)
        for row in setup.collect():
            columns = dims.column_list(row.sink_columns, row.sink_pk)
            publish = None
            if catalog:
                _create(spark, row, columns)
                publish = functools.partial(_published, row.sink_table)
            own = dims.cells(changes.where(F.col("sink_table") == row.sink_table), version)
            tables.merged_batches(f"{base}/{row.sink_table}", ["key"],
                                  lambda rows: dims.merged_cells(rows, [tables.PART, BATCH]), parts, stream, publish)(own, batch)
    return write


MOST_TABLES = 10_000


def _create(spark: SparkSession, row: Row, columns: Sequence[str]) -> None:
    """The catalog table of a configuration row, with all of its columns."""
    spark.sql(dims.create_table_sql(row.sink_table, row.sink_columns, row.sink_pk, row.sink_extend, tables.PART))
    known = spark.table(row.sink_table).columns
    new = [c for c in columns if c not in known]
    if new:
        spark.sql(f"ALTER TABLE {row.sink_table} ADD COLUMNS ({', '.join(f'`{c}` STRING' for c in new)})")


def _published(sink_table: str, done: DataFrame) -> None:
    """Put whole partitions into the catalog table, whose own columns say the order."""
    names = done.sparkSession.table(sink_table).columns
    rows = dims.wide(done, [c for c in names if c != tables.PART], [tables.PART])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(sink_table)


def read_dimension_table(spark: SparkSession, base: str, sink_table: str, sink_columns: str,
                         sink_pk: str | None = None) -> DataFrame:
    """A dimension table of :func:`dimension_table_batches`."""
    return dims.wide(tables.read_table(spark, f"{base}/{sink_table}"), dims.column_list(sink_columns, sink_pk))


def change_stream(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed change log, dead letters) of a stream of JSON lines."""
    good, dirty = parse.split_valid(lines)
    return parse.change_log(good.select("value")), dirty.select("value")
