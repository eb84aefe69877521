"""Cart, order, payment and refund jobs.

Detail jobs read the row change log (``operators.parse.change_log``); window jobs
read the detail frames.  Columns of detail frames are text, as in the change log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart import fixed
from tidemart.functions.money import MONEY, line_amount, money, money_or_zero, total
from tidemart.functions.times import date_id, datetime_of, day_text, seconds_of
from tidemart.operators.changelog import changed_to, increase, table_rows
from tidemart.operators.joins import decode, lookup
from tidemart.operators.keyed import first_by_key, first_times, latest_by_key, new_and_daily
from tidemart.operators.windows import bounds, windowed

WIDE_COLUMNS = (
    "id", "order_id", "sku_id", "source_id", "source_type", "detail_create_time",
    "order_price", "sku_num", "split_original_total_amount", "split_total_amount",
    "split_activity_amount", "split_coupon_amount", "user_id", "province_id", "type", "old",
    "activity_id", "activity_rule_id", "activity_create_time", "coupon_id", "coupon_use_id",
    "coupon_create_time", "source_type_name", "row_op_ts")

# What the wide order table takes from the row images of its four source tables.
WIDE_FIELDS = (
    "id", "order_id", "sku_id", "source_id", "source_type", "create_time", "order_price", "sku_num",
    "split_total_amount", "split_activity_amount", "split_coupon_amount", "user_id", "province_id",
    "order_detail_id", "activity_id", "activity_rule_id", "coupon_id", "coupon_use_id")


# Details from the change log.

def cart_add(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Additions to carts: new rows, and updates that raise the piece count."""
    passes, added = increase("sku_num")
    rows = log.where((F.col("table") == fixed.CART_INFO) & passes).select(
        *[F.col("data")[c].alias(c) for c in ("id", "user_id", "sku_id")],
        F.col("data")["source_type"].alias("source_type_code"), added.alias("sku_num"), "ts")
    return decode(rows, dictionary, "source_type_code", "source_type_name").select(
        "id", "user_id", "sku_id", "source_type_code", "source_type_name", "sku_num", "ts")


def _order_details(log: DataFrame) -> DataFrame:
    rows = table_rows(log, fixed.ORDER_DETAIL, [
        "id", "order_id", "sku_id", "source_id", "source_type", "create_time", "order_price",
        "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount"],
        [fixed.INSERT])
    return rows.withColumnRenamed("create_time", "detail_create_time").withColumn("ts", _number("ts")).withColumnRenamed("ts", "_detail_ts")


def _number(name: str) -> Column:
    return F.col(name).try_cast("bigint")


def order_wide(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Order details with their order, activity, coupon and source name.

    A detail that misses one of them is kept.  ``row_op_ts`` is the newest change
    that went into a row; it orders the versions of one detail.  What can be made of other columns is
    made after the joins, so that it is not shuffled; details are shuffled twice.
    """
    orders = table_rows(log, fixed.ORDER_INFO, ["id", "user_id", "province_id"],
                        [fixed.INSERT, fixed.UPDATE], extra=("type", "old", "ts"))
    orders = orders.withColumn("ts", _number("ts")).withColumnRenamed("id", "_order").withColumnRenamed("ts", "_order_ts")
    activity = table_rows(log, fixed.ORDER_DETAIL_ACTIVITY, [
        "order_detail_id", "activity_id", "activity_rule_id", "create_time"], [fixed.INSERT])
    activity = activity.select(F.col("order_detail_id").alias("_for_activity"), "activity_id",
                               "activity_rule_id",
                               F.col("create_time").alias("activity_create_time"),
                               _number("ts").alias("_activity_ts"))
    coupon = table_rows(log, fixed.ORDER_DETAIL_COUPON, [
        "order_detail_id", "coupon_id", "coupon_use_id", "create_time"], [fixed.INSERT])
    coupon = coupon.select(F.col("order_detail_id").alias("_for_coupon"), "coupon_id",
                           "coupon_use_id", F.col("create_time").alias("coupon_create_time"),
                           _number("ts").alias("_coupon_ts"))
    details = _order_details(log)
    ordered = details.join(orders, details["order_id"] == orders["_order"], "left").drop("_order")
    joined = (ordered.withColumn("_ts", F.greatest("_detail_ts", "_order_ts")).drop("_detail_ts", "_order_ts")
                     .join(activity, F.col("id") == F.col("_for_activity"), "left")
                     .join(coupon, F.col("id") == F.col("_for_coupon"), "left"))
    newest = F.greatest("_ts", "_activity_ts", "_coupon_ts")
    amount = line_amount(F.col("order_price"), F.col("sku_num"))
    wide = decode(joined, dictionary, "source_type", "source_type_name")
    return wide.withColumns({"split_original_total_amount": amount, "row_op_ts": F.timestamp_seconds(newest)}).select(*WIDE_COLUMNS)


def order_detail(wide: DataFrame) -> DataFrame:
    """Details of newly placed orders."""
    return wide.where(F.col("type") == fixed.INSERT).drop("type", "old")


# What payment detail takes from an order detail.
PAID_COLUMNS = ("id", "order_id", "user_id", "sku_id", "province_id", "source_id", "source_type",
                "source_type_name", "activity_id", "activity_rule_id", "coupon_id", "sku_num",
                "split_original_total_amount", "split_activity_amount", "split_coupon_amount",
                "split_total_amount")


def payments(log: DataFrame) -> DataFrame:
    """Payments that were called back, by ``_order``."""
    paid = log.where((F.col("table") == fixed.PAYMENT_INFO)
                     & F.col("data")["callback_time"].isNotNull())
    return paid.select(F.col("data")["order_id"].alias("_order"),
                       F.col("data")["payment_type"].alias("payment_type_code"),
                       F.col("data")["callback_time"].alias("callback_time"),
                       F.col("ts").alias("ts"))


def payment_rows(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Payment details of order details joined with their payments."""
    named = decode(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "province_id",
        "source_id", F.col("source_type").alias("source_type_code"), "source_type_name",
        "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", "callback_time", "sku_num",
        F.col("split_original_total_amount").alias("split_original_amount"),
        "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), "ts")


def payment_detail(log: DataFrame, details: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Order details that were paid, with the payment."""
    return payment_rows(details.join(payments(log), F.col("order_id") == F.col("_order")), dictionary)


def refund_requests(log: DataFrame) -> DataFrame:
    return table_rows(log, fixed.ORDER_REFUND_INFO, [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time"], [fixed.INSERT])


def refunded_orders(log: DataFrame) -> DataFrame:
    """Orders once they are marked refunded, by ``_order``."""
    refunded = log.where((F.col("table") == fixed.ORDER_INFO)
                         & changed_to("order_status", fixed.REFUNDED))
    return refunded.select(F.col("data")["id"].alias("_order"),
                           F.col("data")["province_id"].alias("province_id"),
                           F.col("ts").alias("_order_ts"))


def refund_rows(joined: DataFrame, dictionary: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Refund details of requests joined with their orders, if they have one."""
    named = decode(decode(joined, dictionary, "refund_type", "refund_type_name"),
                   dictionary, "refund_reason_type", "refund_reason_type_name")
    newest = F.greatest(F.col("ts").try_cast("bigint"), F.col("_order_ts").try_cast("bigint"))
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        date_id(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts",
        F.timestamp_seconds(newest).alias("row_op_ts"), *extra)


def refund_detail(log: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refund requests with the province of the order, once that is marked refunded."""
    joined = refund_requests(log).join(refunded_orders(log), F.col("order_id") == F.col("_order"), "left")
    return refund_rows(joined, dictionary)


# Windows over details.

def latest_details(details: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """The last version of each order detail."""
    return latest_by_key(details, ["id"], ["row_op_ts"], ties)


def timed(rows: DataFrame, *columns: str) -> DataFrame:
    """``user_id, event_time`` of change-log times, and further columns."""
    return rows.select("user_id", *columns, seconds_of(F.col("ts")).alias("event_time"))


def cart_window(carts: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Users by their first addition to a cart of the day."""
    return cart_totals(first_times(timed(carts), ["user_id"], "event_time"), size)


def cart_totals(firsts: DataFrame, size: str) -> DataFrame:
    return windowed(firsts, "event_time", size, [F.count("*").alias("cart_add_uu_ct")])


def payment_window(payments: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Users by their first payment of the day, and those who pay for the first time."""
    days = first_times(timed(payments, "callback_time"), ["user_id"], "event_time",
                       day_of=day_text(F.col("callback_time")))
    return payment_totals(new_and_daily(days, "user_id"), size)


def payment_totals(days: DataFrame, size: str) -> DataFrame:
    return windowed(days, "event_time", size, [
        F.count("*").alias("payment_suc_unique_user_count"),
        F.sum("is_first_day").alias("payment_suc_new_user_count")])


def order_window(details: DataFrame, size: str = "10 seconds",
                 amounts: str = "first") -> DataFrame:
    """Users by their first order of the day, those who order for the first time, and
    amounts.

    With ``amounts="first"`` only the first detail of a user and day counts towards
    the amounts; with ``"all"`` every detail does, in its own window.
    ``details`` holds one version per id (see :func:`latest_details`).
    """
    if amounts not in ("first", "all"):
        raise ValueError("amounts is 'first' or 'all'")
    rows = order_rows(details)
    order = F.struct("event_time", "id")
    days = rows.groupBy("user_id", "date").agg(
        F.min_by(F.struct("event_time", *AMOUNTS), order).alias("f"))
    days = new_and_daily(days.select("user_id", "date", "f.*"), "user_id")
    counted = days.select("event_time", F.lit(1).alias("unique"), F.col("is_first_day").alias("new"), *AMOUNTS)
    if amounts == "all":
        none, zero = F.lit(0).cast(MONEY), F.lit(0).cast("bigint")
        counted = counted.withColumns({c: none for c in AMOUNTS}).unionByName(rows.select(
            "event_time", F.lit(0).alias("unique"), zero.alias("new"), *AMOUNTS))
    return order_totals(counted, size)


AMOUNTS = ("activity", "coupon", "original")


def order_rows(details: DataFrame) -> DataFrame:
    return details.select(
        "user_id", "id", datetime_of(F.col("detail_create_time")).alias("event_time"),
        day_text(F.col("detail_create_time")).alias("date"),
        money_or_zero(F.col("split_activity_amount")).alias("activity"),
        money_or_zero(F.col("split_coupon_amount")).alias("coupon"),
        money(F.col("split_original_total_amount")).alias("original"))


def order_totals(counted: DataFrame, size: str) -> DataFrame:
    return windowed(counted, "event_time", size, [
        F.sum("unique").alias("order_unique_user_count"),
        F.sum("new").alias("order_new_user_count"),
        total(F.col("activity")).alias("order_activity_reduce_amount"),
        total(F.col("coupon")).alias("order_coupon_reduce_amount"),
        total(F.col("original")).alias("order_original_total_amount")])


def province_totals(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Amount and number of orders per window and province.

    An order counts once, where its first detail is.  Details are first added up per
    order, window and province (combined before the shuffle, and without a shuffle if
    the details were joined on the order), so the ordering per order runs over its
    windows and not over its details.
    """
    rows = details.select("order_id", "province_id",
                          datetime_of(F.col("detail_create_time")).alias("event_time"),
                          money(F.col("split_total_amount")).alias("amount"))
    parts = rows.groupBy("order_id", "province_id", F.window("event_time", size).alias("_span")).agg(
        F.sum("amount").alias("amount"), F.min("event_time").alias("event_time"))
    place = F.row_number().over(Window.partitionBy("order_id").orderBy("event_time", "province_id"))
    counted = parts.withColumn("_first", (place == 1).cast("bigint"))
    return bounds(counted.groupBy("_span", "province_id").agg(
        F.sum("_first").alias("order_count"), total(F.col("amount")).alias("order_amount")), "_span")


def province_window(details: DataFrame, provinces: DataFrame,
                    size: str = "10 seconds") -> DataFrame:
    """:func:`province_totals` with province names, looked up after aggregation."""
    return province_names(province_totals(details, size), provinces)


def province_names(totals: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(totals, provinces, "province_id", "id", {"province_name": "name"}).select(
        "stt", "edt", "province_id", "province_name", "order_count", "order_amount")


CATALOG = ("trademark_id", "trademark_name", "category1_id", "category1_name",
           "category2_id", "category2_name", "category3_id", "category3_name")


def spu_window(details: DataFrame, catalog: DataFrame, size: str = "10 seconds",
               count: str = "id") -> DataFrame:
    """Orders and amount per brand, categories, user and product.

    ``count`` names the column whose distinct values are counted: the detail id, or
    ``order_id`` to count an order once per product.  ``catalog`` is the flattened
    dimension; ``details`` holds one version per id.
    """
    rows = details.select("user_id", "sku_id", F.col(count).alias("_counted"),
                          datetime_of(F.col("detail_create_time")).alias("event_time"),
                          money(F.col("split_total_amount")).alias("amount"))
    named = {c: c for c in (*CATALOG, "spu_id", "spu_name")}
    joined = lookup(rows, catalog, "sku_id", "sku_id", named)
    return windowed(joined, "event_time", size, [
        F.count_distinct("_counted").alias("order_count"),
        total(F.col("amount")).alias("order_amount")],
        [*CATALOG, "user_id", "spu_id", "spu_name"])


def refund_window(refunds: DataFrame, catalog: DataFrame, size: str = "10 seconds",
                  ties: Sequence[str] = ()) -> DataFrame:
    """Refund requests per user and sku, shown with brand and categories.

    Counted first and looked up after.  The sku itself is not shown, so a user can
    have several rows of one brand in a window.
    """
    once = first_by_key(refunds, ["id"], ["row_op_ts", *ties])
    rows = once.select("user_id", "sku_id", datetime_of(F.col("create_time")).alias("event_time"))
    return refund_names(refund_totals(rows, size), catalog).drop("sku_id")


def refund_totals(rows: DataFrame, size: str) -> DataFrame:
    """Requests per window, user and sku of rows that hold each request once."""
    return windowed(rows, "event_time", size, [F.count("*").alias("refund_count")], ["user_id", "sku_id"])


def refund_names(totals: DataFrame, catalog: DataFrame) -> DataFrame:
    named = lookup(totals, catalog, "sku_id", "sku_id", {c: c for c in CATALOG})
    return named.select("stt", "edt", *CATALOG, "user_id", "sku_id", "refund_count")


def sku_totals(rows: DataFrame, size: str) -> DataFrame:
    """Orders and amount per window, user and sku of rows that hold each detail once."""
    return windowed(rows, "event_time", size, [F.count("*").alias("order_count"), F.sum("amount").alias("amount")],
                    ["user_id", "sku_id"])


def spu_rows(totals: DataFrame, catalog: DataFrame) -> DataFrame:
    """Totals per sku added up per brand, categories, user and product."""
    named = lookup(totals, catalog, "sku_id", "sku_id", {c: c for c in (*CATALOG, "spu_id", "spu_name")})
    return (named.groupBy("stt", "edt", *CATALOG, "user_id", "spu_id", "spu_name")
            .agg(F.sum("order_count").alias("order_count"), total(F.col("amount")).alias("order_amount")))
