"""Operators on small hand-written rows, edge cases first."""

import contextlib
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions import durations, money, names, times, tokens
from tidemart.operators import bounce, changelog, dims, joins, keyed, parse, ranged, skew, sliding
from tidemart.plans import reports, trade, traffic, users
from tidemart.sources import dictionary, snapshot_then_changes, space_records

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def at(seconds=0, days=0):
    return T0 + dt.timedelta(days=days, seconds=seconds)


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


def page_rows(spark, rows):
    """(id, mid, last_page_id, seconds) rows as a page log."""
    return spark.createDataFrame(
        [(i, (m, m, "v1", "c", "a", "1"), ("home", last, None, None, 100), at(s)) for i, m, last, s in rows],
        "id int, common struct<mid:string,uid:string,vc:string,ch:string,ar:string,is_new:string>, "
        "page struct<page_id:string,last_page_id:string,item:string,item_type:string,during_time:bigint>, "
        "event_time timestamp")


@contextlib.contextmanager
def in_parts(spark, n):
    """So many shuffle partitions, however few rows."""
    names = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Bounces.

@pytest.mark.parametrize("follow,expected", [
    ([], [1]),
    ([(2, None, 5)], [1, 2]),
    ([(2, "home", 9)], []),
    ([(2, "home", 10)], [1]),
    ([(2, "home", 11)], [1]),
    ([(2, "home", 0)], []),
])
def test_bounce_edges(spark, follow, expected):
    rows = [(1, "m", None, 0)] + [(i, "m", last, s) for i, last, s in follow]
    assert ids(traffic.bounce_detail(page_rows(spark, rows), ties=["id"])) == expected


def test_bounces_cut_into_buckets_equal_a_plain_scan(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.6 else f"m{rng.randrange(5)}",
             rng.choice([None, "home"]), rng.randrange(4000)) for i in range(1500)]
    expected = []
    for mid in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == mid), key=lambda r: (r[3], r[0]))
        for a, b in zip(own, own[1:] + [None]):
            if a[2] is None and (b is None or b[2] is None or b[3] - a[3] >= 10):
                expected.append(a[0])
    pages = page_rows(spark, rows).withColumn("mid", F.col("common.mid"))
    for parts in (1, 3, 64):
        with in_parts(spark, parts):
            found = bounce.bounces(pages, "mid", "event_time", F.col("page.last_page_id").isNull(), "10 seconds", ["id"])
            assert ids(found) == sorted(expected)


# Per-key operators.

def test_is_new_holds_on_the_first_day_only(spark):
    rows = [(1, "a", "1", at()), (2, "a", "1", at(60)), (3, "a", "1", at(days=1)),
            (4, "b", "0", at()), (5, "b", "1", at(60)), (6, "b", "1", at(days=2)),
            (7, "c", "1", at()), (8, "c", None, at(5)), (9, None, "1", at())]
    df = spark.createDataFrame(rows, "id int, mid string, is_new string, ts timestamp")
    fixed = {r.id: r.is_new for r in keyed.fix_is_new(df, "mid", "is_new", "ts", ["id"]).collect()}
    assert fixed == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: "0", 7: "1", 8: None, 9: "1"}


def test_ordinals_equal_row_number(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else "hot" if rng.random() < 0.5 else f"k{rng.randrange(4)}",
             at(rng.randrange(500_000))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp")
    place = {}
    for k in {r[1] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])), 1):
            place[r[0]] = n
    for parts in (1, 4, 40):
        with in_parts(spark, parts):
            found = keyed.ordinals(df, ["k"], "ts", ["id"])
            assert {r.id: r.ordinal for r in found.collect()} == place
            assert found.columns == ["id", "k", "ts", "ordinal"]
    assert ids(keyed.toggle(df, ["k"], "ts", ["id"])) == sorted(i for i, n in place.items() if n % 2)


def test_a_hot_key_is_cut_by_its_rows(spark):
    """A third of all rows are one key's, in one second: no part holds more than twice its share."""
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.lit(T0).alias("ts"), F.col("id").alias("n"))
    with in_parts(spark, 12):
        dealt = ranged.ranged(rows, ["k"], ["ts", "n"])
        sizes = [r["count"] for r in dealt.groupBy(ranged.PART).count().collect()]
        hot = dealt.where("k = 'hot'").select(ranged.PART).distinct().count()
        placed = ranged.with_place(dealt, ["k"], ["ts", "n"], "place").where("k = 'hot'").collect()
    assert len(sizes) >= 10 and max(sizes) <= 2 * 9_000 / 12 and hot >= 4
    assert {r.n: r.place for r in placed} == {n: n // 3 + 1 for n in range(0, 9_000, 3)}


def test_rows_without_an_order_among_them_are_split_too(spark):
    same = spark.range(4_000).select(F.lit("k").alias("k"), F.lit(T0).alias("ts"))
    with in_parts(spark, 8):
        dealt = ranged.ranged(same, ["k"], ["ts"])
        assert dealt.select(ranged.PART).distinct().count() >= 7
        places = ranged.with_place(dealt, ["k"], ["ts"], "place")
        assert sorted(r.place for r in places.collect()) == list(range(1, 4_001))


def test_latest_by_key_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 5), ("a", 2, 3), ("b", 1, 1)], "k string, v int, t int")
    rows = keyed.latest_by_key(df, ["k"], ["v"], ["t"]).collect()
    assert sorted(map(tuple, rows)) == [("a", 2, 3), ("b", 1, 1)]


@pytest.mark.parametrize("days,expected", [([0, 7], 0), ([0, 8], 1), ([0, 3, 12], 1), ([0], 0)])
def test_returning_users(spark, days, expected):
    pages = page_rows(spark, [(n, "u", None, d * 86400) for n, d in enumerate(days)]
                      + [(99, "u", "home", 20 * 86400)])
    total = users.login_window(pages, "100 days").agg(
        F.sum("back_ct").alias("back"), F.sum("uu_ct").alias("uu")).first()
    assert (total.back, total.uu) == (expected, len(days))


def test_out_of_order_days_count_once(spark):
    pages = page_rows(spark, [(1, "m", None, 0), (2, "m", None, 86400), (3, "m", None, 60)])
    assert ids(traffic.uv_detail(pages, ["id"])) == [1, 2]


# Joins.

def test_skewed_join_equals_plain_join(spark):
    rng = random.Random(3)
    big = spark.createDataFrame(
        [(i, None if i % 97 == 0 else "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}")
         for i in range(5000)], "id int, k string")
    small = spark.createDataFrame([(f"k{n}", n) for n in range(150)] + [("hot", -1), ("hot", -2)],
                                  "k string, v int")
    for how in ("inner", "left"):
        for most in (1, 5, 1000):
            mine = skew.skewed_join(big, small, ["k"], how, parts=most)
            plain = big.join(small, "k", how).select("k", "id", "v")
            assert sorted(map(repr, mine.select("k", "id", "v").collect())) == sorted(map(repr, plain.collect()))


def test_hot_keys_are_bounded_and_hold_the_heavy_one(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k")
    hot = [r.k for r in skew.hot_keys(df, ["k"], parts=10).collect()]
    assert len(hot) == 10 and "hot" in hot


def test_interval_join_bounds(spark):
    orders = spark.createDataFrame([("o", at(100))], "k string, ots timestamp")
    details = spark.createDataFrame([(s, "o", at(100 + s)) for s in (-6, -5, 0, 5, 6)] + [(0, "x", at(100))],
                                    "s int, k string, dts timestamp")
    assert ids(joins.interval_join(orders, details, "k", "ots", "dts"), "s") == [-5, 0, 5]
    assert ids(joins.interval_join(orders, details, "k", "ots", "dts", "0 seconds", "6 seconds"), "s") == [0, 5, 6]


def test_interval_join_equals_all_pairs(spark):
    rng = random.Random(4)
    left = [(i, rng.choice("ab"), rng.randrange(-500, 500)) for i in range(200)]
    right = [(i, rng.choice("ab"), rng.randrange(-500, 500)) for i in range(200)]
    l_df = spark.createDataFrame([(i, k, at(s)) for i, k, s in left], "a int, k string, lts timestamp")
    r_df = spark.createDataFrame([(i, k, at(s)) for i, k, s in right], "b int, k string, rts timestamp")
    pairs = joins.interval_join(l_df, r_df, "k", "lts", "rts", "-7 seconds", "20 seconds")
    expected = sorted((a, b) for a, k, s in left for b, j, u in right if k == j and -7 <= u - s <= 20)
    assert sorted((r.a, r.b) for r in pairs.collect()) == expected


def test_cogroup_lists(spark):
    left = spark.createDataFrame([("k", at(1), "l1"), ("k", at(2), "l2"), ("k", at(7), "l3")], "k string, lts timestamp, l string")
    right = spark.createDataFrame([("k", at(3), "r1"), ("j", at(3), "r2")], "k string, rts timestamp, r string")
    rows = joins.window_cogroup(left, right, "k", "lts", "rts", [F.array_sort(F.collect_list("l")).alias("ls")],
                                [F.array_sort(F.collect_list("r")).alias("rs")]).collect()
    assert sorted((r.stt[-8:], r.k, tuple(r.ls or ()), tuple(r.rs or ())) for r in rows) == [
        ("12:00:00", "j", (), ("r2",)), ("12:00:00", "k", ("l1", "l2"), ("r1",)), ("12:00:05", "k", ("l3",), ())]


def test_window_join_needs_the_same_window(spark):
    left = spark.createDataFrame([("k", at(4), 1)], "k string, lts timestamp, l int")
    right = spark.createDataFrame([("k", at(0), 1), ("k", at(5), 2)], "k string, rts timestamp, r int")
    assert ids(joins.window_join(left, right, "k", "lts", "rts"), "r") == [1]


def test_missing_dimension_is_dropped_or_kept(spark):
    facts = spark.createDataFrame([("1",), ("2",)], "k string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    assert joins.lookup(facts, dim, "k", "id", {"n": "name"}).collect() == [("1", "one")]
    assert sorted(joins.lookup(facts, dim, "k", "id", {"n": "name"}, "left").collect()) == [("1", "one"), ("2", None)]


def test_latest_partner_keeps_unmatched_details(spark):
    orders = spark.createDataFrame([("a", at(1), "old"), ("a", at(2), "new")], "k string, ots timestamp, o string")
    details = spark.createDataFrame([("a", 1), ("b", 2)], "k string, d int")
    rows = joins.latest_partner(details, orders, "k", "ots").select("d", "o").collect()
    assert sorted(map(tuple, rows)) == [(1, "new"), (2, None)]


def test_sliding_counts_a_value_once_per_window(spark):
    df = spark.createDataFrame([("s", at(0), "o1"), ("s", at(2), "o1"), ("s", at(3), "o2")],
                               "k string, ts timestamp, v string")
    rows = sliding.distinct_exact(df, "ts", ["k"], "v", "6 seconds", "2 seconds").collect()
    assert sorted((r.stt[-8:], r.ct) for r in rows) == [
        ("11:59:56", 1), ("11:59:58", 2), ("12:00:00", 2), ("12:00:02", 2)]


# Change log.

def log_rows(spark, rows):
    return spark.createDataFrame(rows, "table string, type string, ts string, data map<string,string>, old map<string,string>")


def test_cart_rows(spark):
    def row(i, kind, now, before):
        return ("cart_info", kind, "100", {"id": i, "user_id": "u", "sku_id": "s", "source_type": "1", "sku_num": now}, before)
    log = log_rows(spark, [
        row("new", "insert", "3", None), row("same", "update", "3", {"sku_num": "3"}),
        row("less", "update", "2", {"sku_num": "3"}), row("more", "update", "5", {"sku_num": "3"}),
        row("other", "update", "5", {"is_order": "0"}), row("gone", "delete", "5", None),
        ("other_table", "insert", "100", {"id": "x", "sku_num": "1"}, None)])
    dic = dictionary(spark.createDataFrame([("1", "search", "0")], "dic_code string, dic_name string, parent_code string"))
    rows = {r.id: (r.sku_num, r.source_type_name) for r in trade.cart_add(log, dic).collect()}
    assert rows == {"new": (3, "search"), "more": (2, "search")}


def test_refund_needs_a_status_change(spark):
    log = log_rows(spark, [
        ("order_refund_info", "insert", "5", {"id": "r1", "order_id": "o1", "create_time": "2024-03-01 10:00:00"}, None),
        ("order_refund_info", "insert", "5", {"id": "r2", "order_id": "o2", "create_time": "2024-03-01 10:00:00"}, None),
        ("order_info", "update", "9", {"id": "o1", "province_id": "7", "order_status": "1005"}, {"order_status": "1002"}),
        ("order_info", "update", "9", {"id": "o2", "province_id": "8", "order_status": "1005"}, {"note": "x"})])
    dic = spark.createDataFrame([], schemas.DICTIONARY)
    rows = {r.id: (r.province_id, r.date_id, r.row_op_ts) for r in trade.refund_detail(log, dic).collect()}
    utc = [dt.datetime.fromtimestamp(s) for s in (5, 9)]
    assert rows == {"r1": ("7", "2024-03-01", utc[1]), "r2": (None, "2024-03-01", utc[0])}


def test_payment_without_callback_is_left_out(spark):
    log = log_rows(spark, [
        ("payment_info", "update", "5", {"order_id": "1", "payment_type": "9", "callback_time": "2024-03-01 10:00:00"}, None),
        ("payment_info", "insert", "4", {"order_id": "1", "payment_type": "9"}, None)])
    details = spark.createDataFrame([("d", "1", "u")], "id string, order_id string, user_id string")
    for name in ("sku_id", "province_id", "source_id", "source_type", "source_type_name", "activity_id",
                 "activity_rule_id", "coupon_id", "sku_num", "split_original_total_amount",
                 "split_activity_amount", "split_coupon_amount", "split_total_amount"):
        details = details.withColumn(name, F.lit("1"))
    paid = trade.payment_detail(log, details, spark.createDataFrame([], schemas.DICTIONARY)).collect()
    assert [(r.order_detail_id, r.ts, r.payment_type_name) for r in paid] == [("d", "5", None)]
    assert len(paid[0]) == 20


def test_envelopes(spark):
    rows = [("r", {"a": "0"}, {"a": "1"}), ("c", None, {"a": "1"}), ("u", {"a": "1"}, {"a": "2"}),
            ("d", {"a": "2"}, None), ("?", {"a": "3"}, {"a": "4"})]
    df = spark.createDataFrame([(b, a, ("t",), op) for op, b, a in rows], schemas.CDC_ENVELOPE)
    flat = [(r.type, r.before, r.after) for r in changelog.flatten_envelopes(df).collect()]
    assert flat == [("bootstrap-insert", {}, {"a": "1"}), ("insert", {}, {"a": "1"}),
                    ("update", {"a": "1"}, {"a": "2"}), ("delete", {"a": "2"}, {}), (None, {}, {})]
    snapshot = spark.createDataFrame([("7", 8)], "a string, b int")
    both = snapshot_then_changes(snapshot, "t", df.where("op = 'u'")).collect()
    assert [(r.type, r.after) for r in both] == [("bootstrap-insert", {"a": "7", "b": "8"}), ("update", {"a": "2"})]


# Dimensions.

def envelopes(spark, rows):
    return spark.createDataFrame([(n, None, after, ("table_process",), op) for n, op, after in rows],
                                 "version int, before map<string,string>, after map<string,string>, "
                                 "source struct<table:string>, op string")


def test_config_routing_and_partial_upserts(spark):
    config = dims.current_config(envelopes(spark, [
        (1, "r", {"source_table": "sku", "sink_table": "dim_sku", "sink_columns": "id,name"}),
        (2, "u", {"source_table": "sku", "sink_table": "dim_sku", "sink_pk": "", "sink_columns": "id,name,price"}),
        (3, "d", None)]), ["version"])
    row = config.first()
    assert (row.sink_pk, row.sink_extend, row.sink_columns) == ("id", "", "id,name,price")
    log = log_rows(spark, [
        ("sku", "insert", "1", {"id": "1", "name": "a", "price": "5", "extra": "x"}, None),
        ("sku", "update", "2", {"id": "1", "price": "6"}, None),
        ("sku", "bootstrap-insert", "1", {"id": "2", "name": "b"}, None),
        ("sku", "delete", "3", {"id": "1"}, None),
        ("unknown", "insert", "1", {"id": "9"}, None)])
    routed = dims.route(log, config)
    assert sorted((r.type, tuple(sorted(r.data))) for r in routed.collect()) == [
        ("bootstrap-insert", ("id", "name")), ("insert", ("id", "name", "price")), ("update", ("id", "price"))]
    table = dims.upserted(routed, "dim_sku", ["id", "name", "price"], "id", [F.col("ts").cast("int")])
    assert sorted(map(tuple, table.collect())) == [("1", "a", "6"), ("2", "b", None)]


def test_routing_keeps_the_key_and_sets_rows_without_one_apart(spark):
    config = dims.current_config(envelopes(spark, [
        (1, "r", {"source_table": "sku", "sink_table": "dim_sku", "sink_pk": "id", "sink_columns": "name"})]), ["version"])
    log = log_rows(spark, [
        ("sku", "insert", "1", {"id": "1", "name": "a"}, None),
        ("sku", "insert", "1", {"id": "2", "name": "b"}, None),
        ("sku", "insert", "2", {"name": "c"}, None)])
    routed = dims.route(log, config)
    table = dims.upserted(routed, "dim_sku", dims.column_list("name", "id"), "id", [F.col("ts").cast("int")])
    assert sorted(map(tuple, table.collect())) == [("1", "a"), ("2", "b")]
    assert [r.data for r in dims.keyless(routed).collect()] == [{"name": "c"}]


def test_dimension_table_definition():
    assert dims.column_list("name,code", "code") == ["code", "name"]
    assert [(f.name, f.nullable) for f in dims.table_schema("id,name").fields] == [("id", False), ("name", True)]
    assert dims.create_table_sql("dim_x", "id,name", None, "TBLPROPERTIES ('a'='b')") == (
        "CREATE TABLE IF NOT EXISTS dim_x (`id` STRING NOT NULL, `name` STRING) USING parquet TBLPROPERTIES ('a'='b')")


# Log parsing.

LINES = [
    json.dumps({"common": {"mid": "m", "is_new": "1", "os": "x"}, "page": {"page_id": "home", "extra": 1}, "ts": 1709290000000,
                "displays": [{"item": "3", "nested": {"a": [1]}}], "actions": [], "err": None}),
    json.dumps({"common": {"mid": "m", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 1709290001000}),
    json.dumps({"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "cart"}, "error": "E", "ts": 1709390001000}),
    '{"common": {"mid"', "", None, "[1]", '{"common": {}, "page": {}}', '{"common": {"mid": "m"}}']


def test_split_log(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    rows = [(r.route, r.value) for r in traffic.split_log(lines).collect()]
    count = {}
    for route, _ in rows:
        count[route] = count.get(route, 0) + 1
    assert count == {"page": 2, "start": 1, "display": 1, "error": 1, "dirty": 6}
    by = {r: [json.loads(v) for q, v in rows if q == r] for r in ("page", "start", "display", "error")}
    assert by["start"] == [{"entry": "icon"}]
    assert by["display"] == [{"item": "3", "nested": {"a": [1]}, "page": "home", "ts": "1709290000000"}]
    home = next(p for p in by["page"] if p["page"]["page_id"] == "home")
    assert home == {"common": {"mid": "m", "is_new": "1", "os": "x"}, "page": {"page_id": "home", "extra": 1},
                    "ts": 1709290000000, "err": None}
    assert by["error"][0]["common"]["is_new"] == "0" and by["error"][0]["error"] == "E"


def test_typed_logs(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    assert sorted(r.page.page_id for r in parse.page_log(lines).collect() if r.page.page_id) == ["cart", "home"]
    change = spark.createDataFrame([('{"table":"t","type":"insert","ts":"5","data":{"a":"1"}}',), ("{",)], "value string")
    assert [(r.table, r.data, r.old) for r in parse.change_log(change).collect()] == [("t", {"a": "1"}, None)]


# Functions.

def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_times(spark):
    a, b = F.lit("2022-04-01 11:10:55.040Z"), F.lit("2022-04-01 11:10:55.04Z")
    assert one(spark, times.fraction_time(a) == times.fraction_time(b)) == (True,)
    assert one(spark, times.fraction_time(a) < times.fraction_time(F.lit("2022-04-01 11:10:55.4Z"))) == (True,)
    assert one(spark, times.millis_datetime(times.datetime_millis(F.lit("2022-04-01 11:10:55")))) == ("2022-04-01 11:10:55",)
    assert one(spark, times.datetime_millis(F.lit("no date")), times.date_id(F.lit("x"))) == (None, None)
    assert one(spark, times.day_gap(F.lit("2024-03-01"), F.lit("2024-02-28"))) == (2,)


def test_on_day_takes_timestamps_and_text(spark):
    late, next_day = (F.to_timestamp(F.lit(t)) for t in ("2024-03-01 23:59:59", "2024-03-02 00:00:00"))
    assert one(spark, times.on_day(late, 20240301), times.on_day(next_day, 20240301),
               times.on_day(F.lit("2024-03-01 23:59:59"), 20240301)) == (True, False, True)


def test_time_zone_is_used_both_ways(spark):
    spark.conf.set("spark.sql.session.timeZone", "GMT+8")
    try:
        assert one(spark, times.date_millis(F.lit("1970-01-02")), times.millis_date(F.lit(0))) == (57600000, "1970-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_durations():
    assert durations.micros("10 seconds") == 10_000_000 and durations.micros("-1 day") == -86_400_000_000
    for bad in ("10", "1 fortnight", "1 second; drop"):
        with pytest.raises(ValueError):
            durations.micros(bad)


def test_money_and_names(spark):
    assert one(spark, money.line_amount(F.lit("19.99"), F.lit("3")), money.money_or_zero(F.lit(None).cast("string"))) == (
        "59.97", 0)
    df = spark.range(1).selectExpr("id as tm_id", "id as NAME")
    assert names.camel_columns(df).columns == ["tmId", "name"] and names.upper_columns(df).columns == ["TM_ID", "NAME"]


def test_tokens(spark):
    text = F.lit("Red shoes, 图书馆 A4 书")
    assert one(spark, tokens.words(text)) == (["red", "shoes", "图书馆", "a4", "书"],)
    assert one(spark, tokens.cjk_bigrams(text)) == (["red", "shoes", "图书", "书馆", "a4", "书"],)


def test_space_records(spark):
    df = spark.createDataFrame([("o1 alice 10",), ("short",), ("o2 bob x",)], "value string")
    assert [tuple(r) for r in space_records(df, {"id": "string", "name": "string", "ts": "bigint"}).collect()] == [
        ("o1", "alice", 10), ("short", None, None), ("o2", "bob", None)]


# Windows and reports.

def details(spark, rows):
    return spark.createDataFrame(rows, "id string, order_id string, user_id string, province_id string, sku_id string, "
                                 "detail_create_time string, split_total_amount string, "
                                 "split_original_total_amount string, split_activity_amount string, split_coupon_amount string")


ORDERS = [("1", "o1", "u", "p", "s1", "2024-03-01 10:00:01", "5.10", "6.00", "0.90", None),
          ("2", "o1", "u", "p", "s2", "2024-03-01 10:00:02", "1.10", "2.00", None, "0.90"),
          ("3", "o1", "u", "p", "s2", "2024-03-01 10:00:12", "1.00", "1.00", None, None),
          ("4", "o2", "u", "p", "s1", "2024-03-02 10:00:00", "2.00", "2.00", None, None)]


def test_province_counts_an_order_once(spark):
    rows = trade.province_totals(details(spark, ORDERS)).orderBy("stt").collect()
    assert [(r.stt, r.order_count, r.order_amount) for r in rows] == [
        ("2024-03-01 10:00:00", 1, 6.2), ("2024-03-01 10:00:10", 0, 1.0), ("2024-03-02 10:00:00", 1, 2.0)]


def test_order_window_amounts(spark):
    def run(amounts):
        return [tuple(r)[2:] for r in trade.order_window(details(spark, ORDERS), "1 day", amounts).orderBy("stt").collect()]
    assert run("first") == [(1, 1, 0.9, 0.0, 6.0), (1, 0, 0.0, 0.0, 2.0)]
    assert run("all") == [(1, 1, 0.9, 0.9, 9.0), (1, 0, 0.0, 0.0, 2.0)]


def test_spu_window_counts_details_or_orders(spark):
    catalog = spark.createDataFrame([(s, *["c"] * 8, "spu", "Spu") for s in ("s1", "s2")],
                                    ["sku_id", *trade.CATALOG, "spu_id", "spu_name"])
    one_day = details(spark, ORDERS[:3])
    assert [r.order_count for r in trade.spu_window(one_day, catalog, "1 day").collect()] == [3]
    assert [r.order_count for r in trade.spu_window(one_day, catalog, "1 day", "order_id").collect()] == [1]


def test_reports(spark):
    df = spark.createDataFrame([("2024-03-01 00:00:00", "N", 2, 1.005), ("2024-03-01 23:59:50", "N", 1, 2.0),
                                ("2024-03-02 00:00:00", "N", 1, 9.0)], "stt string, province_name string, order_count bigint, order_amount double")
    assert reports.gmv(df, 20240301).first().gmv == 3.01
    assert reports.gmv(df, 20240310).first().gmv is None
    now = df.withColumn("stt", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    assert reports.gmv(now).first().gmv == 12.01 and reports.gmv(df).first().gmv is None
    row = reports.orders_by_province(df, 20240301).first()
    assert (row.name, row.size_value, row.tooltip_values) == ("N", 3, [3])
