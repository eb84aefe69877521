"""Trade queries on orders, line items and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.bindings import frames
from tidemart.bindings.registry import (CATALOG, CATALOG_COLUMNS, DETAILS, LATEST, LINES, ORDERS,
                                        query, span, text)
from tidemart.operators.keyed import first_by_key
from tidemart.plans import reports, trade

DAY, WEEK, MONTH = 86_400, 604_800, 2_592_000

CART = LINES + """,
cart AS (
  SELECT line_id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS source_type_code,
         CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) - l_linenumber * 5 END AS sku_num,
         l_shipdate
  FROM lines
  WHERE l_linestatus = 'O' OR (l_returnflag <> 'N' AND CAST(l_quantity AS INTEGER) > l_linenumber * 5))"""

WIDE = LINES + "," + ORDERS + f""",
wide AS (
  SELECT line_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(l_suppkey AS VARCHAR) AS source_id, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS source_type,
         {text('l_shipdate')} AS detail_create_time, CAST(price AS VARCHAR) AS order_price,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
         CAST(CAST(price * CAST(l_quantity AS INTEGER) AS DECIMAL(28,2)) AS VARCHAR) AS split_original_total_amount,
         CAST(price - discount AS VARCHAR) AS split_total_amount,
         CASE WHEN l_discount > 0 THEN CAST(discount AS VARCHAR) END AS split_activity_amount,
         CAST(tax AS VARCHAR) AS split_coupon_amount,
         CAST(o_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS province_id,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN 'update' WHEN o_orderstatus = 'O' THEN 'insert' END AS type,
         a.activity_id, a.activity_rule_id, a.create_time AS activity_create_time,
         c.coupon_id, c.coupon_use_id, c.create_time AS coupon_create_time, n_name AS source_type_name,
         greatest(l_shipdate, coalesce(o_orderdate, l_shipdate), coalesce(a.at, l_shipdate),
                  coalesce(c.at, l_shipdate)) AS row_op_ts
  FROM lines
  LEFT JOIN shop_orders ON l_orderkey = o_orderkey
  LEFT JOIN (SELECT line_id AS aid, l_shipdate AS at, CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS activity_id,
                    CAST(l_linenumber AS VARCHAR) AS activity_rule_id, {text('l_shipdate')} AS create_time
             FROM lines WHERE l_discount >= 0.05) a ON line_id = aid
  LEFT JOIN (SELECT line_id AS cid, l_shipdate AS at, CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS coupon_id,
                    CAST(l_suppkey AS VARCHAR) AS coupon_use_id, {text('l_shipdate')} AS create_time
             FROM lines WHERE l_tax >= 0.04) c ON line_id = cid
  LEFT JOIN nation ON n_nationkey = CAST(l_quantity AS INTEGER))"""

PAYMENTS = WIDE + f""",
payments AS (
  SELECT w.id AS order_detail_id, w.order_id, w.user_id, sku_id, province_id, source_id,
         source_type AS source_type_code, source_type_name, activity_id, activity_rule_id, coupon_id,
         left(o.o_orderpriority, 1) AS payment_type_code, n.n_name AS payment_type_name,
         {text('o.o_orderdate')} AS callback_time, sku_num,
         split_original_total_amount AS split_original_amount, split_activity_amount,
         split_coupon_amount, split_total_amount AS split_payment_amount,
         CAST(epoch_us(o.o_orderdate) // 1000000 AS VARCHAR) AS ts
  FROM wide w JOIN orders o ON w.order_id = CAST(o.o_orderkey AS VARCHAR) AND o.o_orderstatus <> 'P'
  LEFT JOIN nation n ON n.n_nationkey = CAST(left(o.o_orderpriority, 1) AS INTEGER)
  WHERE w.type = 'insert')"""

REFUNDS = LINES + "," + ORDERS + f""",
refunds AS (
  SELECT line_id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, CAST(c_nationkey AS VARCHAR) AS province_id,
         strftime(l_shipdate, '%Y-%m-%d') AS date_id, {text('l_shipdate')} AS create_time,
         CAST(l_linenumber AS VARCHAR) AS refund_type_code, a.n_name AS refund_type_name,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_reason_type_code,
         b.n_name AS refund_reason_type_name, l_linestatus AS refund_reason_txt,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num, CAST(price AS VARCHAR) AS refund_amount,
         CAST(epoch_us(l_shipdate) // 1000000 AS VARCHAR) AS ts, l_shipdate,
         greatest(l_shipdate, coalesce(o_orderdate, l_shipdate)) AS row_op_ts
  FROM lines
  LEFT JOIN (SELECT * FROM shop_orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey
  LEFT JOIN nation a ON a.n_nationkey = l_linenumber
  LEFT JOIN nation b ON b.n_nationkey = CAST(l_quantity AS INTEGER)
  WHERE l_returnflag = 'R')"""

PROVINCES = LATEST + f""",
amounts AS (SELECT {span('t', WEEK)}, province_id, CAST(sum(total) AS DOUBLE) AS order_amount
            FROM latest GROUP BY stt, edt, province_id),
firsts AS (SELECT * FROM latest
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY t, province_id) = 1),
counts AS (SELECT {span('t', WEEK)}, province_id, count(*) AS order_count
           FROM firsts GROUP BY stt, edt, province_id),
province_orders AS (
  SELECT stt, edt, province_id, n_name AS province_name, coalesce(order_count, 0) AS order_count, order_amount
  FROM amounts LEFT JOIN counts USING (stt, edt, province_id)
  JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR))"""


def _latest(t):
    return trade.latest_details(frames.details(t), frames.VERSION_TIES)


def _wide(t):
    return trade.order_wide(frames.order_log(t), frames.dictionary(t))


def _payments(t):
    return trade.payment_detail(frames.payment_changes(t), trade.order_detail(_wide(t)),
                                frames.dictionary(t))


def _refunds(t):
    return trade.refund_detail(frames.union(frames.refund_changes(t), frames.order_changes(t)),
                               frames.dictionary(t))


@query("cart_delta", "WITH " + CART + """
SELECT id, user_id, sku_id, source_type_code, n_name AS source_type_name, sku_num,
       CAST(epoch_us(l_shipdate) // 1000000 AS VARCHAR) AS ts
FROM cart LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = source_type_code""")
def cart_delta(t):
    """Additions to carts, with the name of their source."""
    return trade.cart_add(frames.cart_changes(t), frames.dictionary(t))


@query("cart_window", "WITH " + CART + f""",
d AS (SELECT DISTINCT user_id, l_shipdate AS t FROM cart)
SELECT {span('t', WEEK)}, count(*) AS cart_add_uu_ct FROM d GROUP BY stt, edt""")
def cart_window(t):
    """Daily cart users per week."""
    return trade.cart_window(trade.cart_add(frames.cart_changes(t), frames.dictionary(t)), "7 days")


@query("order_wide", "WITH " + WIDE + " SELECT * FROM wide")
def order_wide(t):
    """Line items with order, activity, coupon and source name."""
    return _wide(t).drop("old")


@query("order_detail", "WITH " + WIDE + " SELECT * EXCLUDE (type) FROM wide WHERE type = 'insert'")
def order_detail(t):
    """The wide rows of newly placed orders."""
    return trade.order_detail(_wide(t))


@query("payment_detail", "WITH " + PAYMENTS + " SELECT * FROM payments")
def payment_detail(t):
    """Paid order details with the payment type."""
    return _payments(t)


@query("refund_detail", "WITH " + REFUNDS + " SELECT * EXCLUDE (l_shipdate) FROM refunds")
def refund_detail(t):
    """Refund requests with the province of orders marked refunded."""
    return _refunds(t)


@query("latest_by_key", "WITH " + DETAILS + f""", latest AS (
  SELECT * FROM details QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY t DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)
SELECT id, sku_id, user_id, {text('t')} AS detail_create_time, CAST(total AS VARCHAR) AS split_total_amount FROM latest""")
def latest_by_key(t):
    """The last version of each order detail."""
    return _latest(t).select("id", "sku_id", "user_id", "detail_create_time", "split_total_amount")


@query("earliest_by_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def earliest_by_key(t):
    """The first version of each line."""
    rows = first_by_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", *frames.VERSION_TIES])
    return rows.select("l_orderkey", "l_linenumber", *frames.VERSION_TIES)


_ORDER_WINDOW = LATEST + f""",
days AS (SELECT * FROM latest
         QUALIFY row_number() OVER (PARTITION BY user_id, CAST(t AS DATE) ORDER BY t, id) = 1),
marked AS (SELECT *, t = min(t) OVER (PARTITION BY user_id) AS is_first FROM days)"""


@query("order_window", "WITH " + _ORDER_WINDOW + f"""
SELECT {span('t', WEEK)}, count(*) AS order_unique_user_count,
       count(*) FILTER (is_first) AS order_new_user_count,
       CAST(sum(coalesce(activity, 0)) AS DOUBLE) AS order_activity_reduce_amount,
       CAST(sum(coupon) AS DOUBLE) AS order_coupon_reduce_amount,
       CAST(sum(price) AS DOUBLE) AS order_original_total_amount
FROM marked GROUP BY stt, edt""")
def order_window(t):
    """Ordering users, new ones, and the amounts of their first detail of the day."""
    return trade.order_window(_latest(t), "7 days")


@query("order_window_all", "WITH " + _ORDER_WINDOW + f""",
u AS (SELECT {span('t', WEEK)}, count(*) AS order_unique_user_count,
             count(*) FILTER (is_first) AS order_new_user_count FROM marked GROUP BY stt, edt),
a AS (SELECT {span('t', WEEK)}, CAST(sum(coalesce(activity, 0)) AS DOUBLE) AS order_activity_reduce_amount,
             CAST(sum(coupon) AS DOUBLE) AS order_coupon_reduce_amount,
             CAST(sum(price) AS DOUBLE) AS order_original_total_amount FROM latest GROUP BY stt, edt)
SELECT a.stt, a.edt, coalesce(order_unique_user_count, 0) AS order_unique_user_count,
       coalesce(order_new_user_count, 0) AS order_new_user_count, order_activity_reduce_amount,
       order_coupon_reduce_amount, order_original_total_amount
FROM a LEFT JOIN u USING (stt, edt)""")
def order_window_all(t):
    """The same with the amounts of every detail."""
    return trade.order_window(_latest(t), "7 days", amounts="all")


@query("payment_window", "WITH " + PAYMENTS + f""",
d AS (SELECT user_id, left(callback_time, 10) AS day, min(make_timestamp(CAST(ts AS BIGINT) * 1000000)) AS t
      FROM payments GROUP BY ALL),
m AS (SELECT *, day = min(day) OVER (PARTITION BY user_id) AS is_first FROM d)
SELECT {span('t', WEEK)}, count(*) AS payment_suc_unique_user_count,
       count(*) FILTER (is_first) AS payment_suc_new_user_count FROM m GROUP BY stt, edt""")
def payment_window(t):
    """Paying users and first-time payers per week."""
    return trade.payment_window(_payments(t), "7 days")


def province_orders(t):
    return trade.province_window(_latest(t), frames.provinces(t), "7 days")


@query("province_window", "WITH " + PROVINCES + " SELECT * FROM province_orders")
def province_window(t):
    """Orders and sales per week and province."""
    return province_orders(t)


@query("spu_window", "WITH " + LATEST + "," + CATALOG + f"""
SELECT {span('t', MONTH)}, {CATALOG_COLUMNS}, user_id, spu_id, spu_name,
       count(DISTINCT id) AS order_count, CAST(sum(total) AS DOUBLE) AS order_amount
FROM latest JOIN catalog USING (sku_id) GROUP BY ALL""")
def spu_window(t):
    """Orders and sales per month, brand, categories, user and product."""
    return trade.spu_window(_latest(t), frames.catalog(t), "30 days")


@query("refund_window", "WITH " + REFUNDS + "," + CATALOG + f""",
once AS (SELECT * FROM refunds QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts, create_time, refund_amount) = 1),
totals AS (SELECT {span('l_shipdate', MONTH)}, user_id, sku_id, count(*) AS refund_count
           FROM once GROUP BY stt, edt, user_id, sku_id)
SELECT stt, edt, {CATALOG_COLUMNS}, user_id, refund_count FROM totals JOIN catalog USING (sku_id)""")
def refund_window(t):
    """Refund requests per month, user and sku, shown with brand and categories."""
    return trade.refund_window(_refunds(t), frames.catalog(t), "30 days", ["create_time", "refund_amount"])


@query("report_gmv", "WITH " + PROVINCES + """
SELECT CAST(round(sum(CAST(order_amount AS DECIMAL(16,2))), 2) AS DOUBLE) AS gmv
FROM province_orders WHERE stt LIKE '1998-10-15 %'""")
def report_gmv(t):
    """Sales of the week that starts on a given day."""
    return reports.gmv(province_orders(t), 19981015)


@query("report_province", "WITH " + PROVINCES + """
SELECT province_name AS name, CAST(sum(CAST(order_amount AS DECIMAL(16,2))) AS DOUBLE) AS value,
       CAST(sum(order_count) AS BIGINT) AS size_value, [CAST(sum(order_count) AS BIGINT)] AS tooltip_values
FROM province_orders WHERE stt LIKE '1998-10-15 %' GROUP BY province_name""")
def report_province(t):
    """Map points of the week that starts on a given day."""
    return reports.orders_by_province(province_orders(t), 19981015)
