"""The test tables in the shapes that the jobs read.

Every frame covers a whole table.  Times are read as UTC.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart import fixed
from tidemart.functions.times import window_text
from tidemart.session import tune


class Tables:
    """The tables of one folder, with timestamps as instants."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark, "UTC"), folder

    def __getattr__(self, name: str) -> DataFrame:
        df = instants(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))
        setattr(self, name, df)
        return df


def instants(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp")
                           for c, kind in df.dtypes if kind == "timestamp_ntz"})


def _text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _cents(value: Column) -> Column:
    return value.cast("decimal(16,2)")


def _number(name: str) -> Column:
    """The number ``k`` of an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


# Visitor log from events.

def pages(t: Tables) -> DataFrame:
    """Page log: views are entries to the home page, clicks come from a search and go to
    a product page.  ``event_id`` passes through as a tie-breaker."""
    kind, k = F.col("event_type"), _number("props")
    common = F.struct(
        _text("user_id").alias("mid"),
        F.when(kind != "error", _text("user_id")).alias("uid"),
        F.concat(F.lit("v"), F.floor(k / 50)).alias("vc"),
        F.concat(F.lit("ch"), F.floor(k / 25)).alias("ch"),
        F.when(F.col("value") > 50, "north").otherwise("south").alias("ar"),
        F.when(kind != "error", "1").otherwise("0").alias("is_new"))
    page = F.struct(
        F.when(kind == "view", fixed.HOME_PAGE).when(kind == "click", fixed.DETAIL_PAGE)
         .otherwise(kind).alias("page_id"),
        F.when(kind == "click", fixed.SEARCH_PAGE).when(kind != "view", "list")
         .alias("last_page_id"),
        F.concat(F.lit("Item "), _text(k), F.lit(" - "), kind).alias("item"),
        F.when(kind.isin("click", "error"), fixed.KEYWORD_ITEM_TYPE).alias("item_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"))
    ms = F.unix_millis("ts")
    return t.events.select("event_id", common.alias("common"), page.alias("page"), ms.alias("ts"),
                           F.timestamp_millis(ms).alias("event_time"))


def log_lines(t: Tables) -> DataFrame:
    """Raw log lines: signups are start records, errors carry an error text, and errors
    with a small number are cut off in the middle."""
    kind, k = F.col("event_type"), _number("props")
    text = F.to_json(F.struct(
        F.struct(_text("user_id").alias("mid"),
                 F.when(kind != "error", "1").otherwise("0").alias("is_new")).alias("common"),
        F.when(kind != "signup", F.struct(kind.alias("page_id"))).alias("page"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"),
                                          _text(k).alias("loading_time"))).alias("start"),
        F.when(kind == "view", F.array(
            F.struct(_text(k).alias("item"), F.lit("1").alias("pos")),
            F.struct(_text(k + 1).alias("item"), F.lit("2").alias("pos")))).alias("displays"),
        F.when(kind == "click", F.array(F.struct(
            F.lit("fav").alias("action_id"), _text(k).alias("item")))).alias("actions"),
        F.when(kind == "error", F.concat(F.lit("code "), _text(k))).alias("error"),
        F.unix_millis("ts").alias("ts")))
    cut = (kind == "error") & (k < 10)
    return t.events.select(F.when(cut, F.left(text, F.length(text) / 2)).otherwise(text)
                            .alias("value"))


# Shop database from orders, line items, customers and events.

def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _seconds(name: str) -> Column:
    return _text(F.unix_seconds(F.col(name)))


def _change(rows: DataFrame, table: str, kind: Column, ts: Column,
            data: dict[str, Column], old: dict[str, Column] | None = None) -> DataFrame:
    def image(fields: dict[str, Column] | None) -> Column:
        if not fields:
            return F.lit(None).cast("map<string,string>")
        return F.create_map(*[x for n, v in fields.items() for x in (F.lit(n), v.cast("string"))])
    return rows.select(F.lit(table).alias("table"), kind.alias("type"), ts.alias("ts"),
                       image(data).alias("data"), image(old).alias("old"))


def _price() -> Column:
    return _cents(F.col("l_extendedprice"))


def _share(name: str) -> Column:
    return _cents(_price() * F.col(name).cast("decimal(4,2)"))


def line_amounts() -> dict[str, Column]:
    """Text amounts of a line; no discount means no activity amount."""
    return {
        "split_total_amount": _text(_price() - _share("l_discount")),
        "split_activity_amount": F.when(F.col("l_discount") > 0, _text(_share("l_discount"))),
        "split_coupon_amount": _text(_share("l_tax"))}


def _line_changes(t: Tables, table: str, data: dict[str, Column], where: str = "true") -> DataFrame:
    return _change(t.lineitem.where(where), table, F.lit(fixed.INSERT), _seconds("l_shipdate"), data)


def _created() -> Column:
    return window_text(F.col("l_shipdate"))


def _pieces() -> Column:
    return F.col("l_quantity").cast("int")


def order_detail_changes(t: Tables) -> DataFrame:
    return _line_changes(t, fixed.ORDER_DETAIL, {
        "id": _line_key(), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "source_id": F.col("l_suppkey"), "source_type": _pieces(), "create_time": _created(),
        "order_price": _price(), "sku_num": _pieces(), **line_amounts()})


def activity_changes(t: Tables) -> DataFrame:
    return _line_changes(t, fixed.ORDER_DETAIL_ACTIVITY, {
        "order_detail_id": _line_key(), "order_id": F.col("l_orderkey"),
        "activity_id": F.col("l_discount").cast("decimal(4,2)"),
        "activity_rule_id": F.col("l_linenumber"), "create_time": _created()}, "l_discount >= 0.05")


def coupon_changes(t: Tables) -> DataFrame:
    return _line_changes(t, fixed.ORDER_DETAIL_COUPON, {
        "order_detail_id": _line_key(), "order_id": F.col("l_orderkey"),
        "coupon_id": F.col("l_tax").cast("decimal(4,2)"),
        "coupon_use_id": F.col("l_suppkey"), "create_time": _created()}, "l_tax >= 0.04")


def refund_changes(t: Tables) -> DataFrame:
    return _line_changes(t, fixed.ORDER_REFUND_INFO, {
        "id": _line_key(), "user_id": F.col("l_suppkey"), "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"), "refund_type": F.col("l_linenumber"),
        "refund_num": _pieces(), "refund_amount": _price(), "refund_reason_type": _pieces(),
        "refund_reason_txt": F.col("l_linestatus"), "create_time": _created()}, "l_returnflag = 'R'")


def cart_changes(t: Tables) -> DataFrame:
    """Open lines are new cart rows, the others change a count that some do not carry."""
    kind = F.when(F.col("l_linestatus") == "O", fixed.INSERT).otherwise(fixed.UPDATE)
    return _change(t.lineitem, fixed.CART_INFO, kind, _seconds("l_shipdate"), {
        "id": _line_key(), "user_id": F.col("l_suppkey"), "sku_id": F.col("l_partkey"),
        "source_type": _pieces(), "sku_num": _pieces()},
        {"sku_num": F.when(F.col("l_returnflag") != "N", F.col("l_linenumber") * 5)})


def order_changes(t: Tables) -> DataFrame:
    """Open orders are new, finished ones were refunded, pending ones changed elsewhere."""
    orders = t.orders.join(t.customer.select("c_custkey", "c_nationkey"),
                           F.col("o_custkey") == F.col("c_custkey"))
    state = F.col("o_orderstatus")
    status = F.when(state == "F", fixed.REFUNDED).when(state == "P", "1002").otherwise("1001")
    return _change(orders, fixed.ORDER_INFO,
                   F.when(state != "O", fixed.UPDATE).otherwise(fixed.INSERT),
                   _seconds("o_orderdate"), {
                       "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
                       "province_id": F.col("c_nationkey"), "order_status": status},
                   {"order_status": F.when(state == "F", "1002")})


def payment_changes(t: Tables) -> DataFrame:
    """Payments; those of pending orders have not been called back."""
    return _change(t.orders, fixed.PAYMENT_INFO, F.lit(fixed.INSERT), _seconds("o_orderdate"), {
        "user_id": F.col("o_custkey"), "order_id": F.col("o_orderkey"),
        "payment_type": F.left("o_orderpriority", F.lit(1)),
        "callback_time": F.when(F.col("o_orderstatus") != "P", window_text(F.col("o_orderdate")))})


def user_changes(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", fixed.INSERT).otherwise(fixed.UPDATE)
    return _change(t.events, fixed.USER_INFO, kind, _seconds("ts"), {
        "id": F.col("user_id"), "create_time": window_text(F.col("ts"))})


def union(*parts: DataFrame) -> DataFrame:
    """One change log out of the changes of several source tables."""
    return functools.reduce(DataFrame.unionByName, parts)


def order_log(t: Tables) -> DataFrame:
    """The four source tables of the wide order table."""
    return union(order_detail_changes(t), order_changes(t), activity_changes(t), coupon_changes(t))


def dictionary(t: Tables) -> DataFrame:
    return t.nation.select(_text("n_nationkey").alias("dic_code"), F.col("n_name").alias("dic_name"),
                           _text("n_regionkey").alias("parent_code"))


def details(t: Tables) -> DataFrame:
    """Order details with several versions per id, as a detail table holds them.

    The last four columns break ties between versions of one time.
    """
    orders = t.orders.join(t.customer.select("c_custkey", "c_nationkey"),
                           F.col("o_custkey") == F.col("c_custkey"))
    joined = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        _line_id().alias("id"), _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("sku_id"), _text("o_custkey").alias("user_id"),
        _text("c_nationkey").alias("province_id"),
        window_text(F.col("l_shipdate")).alias("detail_create_time"),
        _text(_price()).alias("split_original_total_amount"),
        *[v.alias(n) for n, v in line_amounts().items()],
        F.col("l_shipdate").alias("row_op_ts"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


VERSION_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def provinces(t: Tables) -> DataFrame:
    return t.nation.select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def catalog(t: Tables) -> DataFrame:
    """Flattened catalog: brand from the brand code, the three category levels from the
    part type and from a nation and its region."""
    from tidemart.operators.joins import flatten_catalog
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1)
    sku = t.part.select(_text("p_partkey").alias("id"), F.concat(F.lit("spu"), _text("p_size")).alias("spu_id"),
                        F.col("p_brand").alias("tm_id"),
                        _text(F.pmod(brand.cast("int"), F.lit(25))).alias("category3_id"))
    spu = t.part.select(F.concat(F.lit("spu"), _text("p_size")).alias("id"),
                        F.concat(F.lit("Size "), _text("p_size")).alias("spu_name")).distinct()
    trademark = t.part.select(F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")).distinct()
    category3 = t.nation.select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                                _text("n_regionkey").alias("category2_id"))
    category2 = t.region.select(_text("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                                F.left("r_name", F.lit(1)).alias("category1_id"))
    category1 = t.region.select(F.left("r_name", F.lit(1)).alias("id"),
                                F.concat(F.lit("Group "), F.left("r_name", F.lit(1))).alias("name")).distinct()
    return flatten_catalog(sku, trademark, category3, category2, category1, spu)
