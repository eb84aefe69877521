"""Streaming forms: several micro-batches must give what one batch gives."""

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemart import schemas, sinks
from tidemart.operators import dims, joins, keyed
from tidemart.plans import trade, traffic
from tidemart.sources import table_stream, text_stream
from tidemart.streaming import jobs, state

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def at(seconds=0, days=0):
    return T0 + dt.timedelta(days=days, seconds=seconds)


class Feed:
    """A folder that a stream reads one file per micro-batch."""

    def __init__(self, spark, tmp_path, schema, name="in"):
        self.spark, self.schema, self.path = spark, schema, str(tmp_path / name)
        os.makedirs(self.path)
        self.count = 0

    def add(self, *batches):
        for rows in batches:
            self.count += 1
            part = f"{self.path}-{self.count}"
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(part)
            file = next(f for f in os.listdir(part) if f.endswith(".parquet"))
            target = f"{self.path}/{self.count:04d}.parquet"
            os.link(f"{part}/{file}", target)
            os.utime(target, (1_700_000_000 + self.count,) * 2)
        return self

    def stream(self):
        return table_stream(self.spark, self.path, self.spark.createDataFrame([], self.schema).schema, 1)


def drain(df, tmp_path, mode="append", name="out"):
    """Run a stream over all that is there; returns the rows it gave, per micro-batch."""
    given = []
    jobs.start(sinks.for_each(df, lambda b, n: given.append([r.asDict() for r in b.collect()]),
                              str(tmp_path / f"{name}-checkpoint"), mode)).awaitTermination()
    return [r for rows in given for r in rows]


BOUNCE = "id int, k string, ts timestamp, entry boolean"


def test_bounces_of_a_disordered_stream(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice("abc"), at(rng.randrange(600)), rng.random() < 0.6) for i in range(150)]
    # Rows arrive up to 20 seconds out of order; the delay allows for that.
    arrival = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rng.randrange(20)))
    feed = Feed(spark, tmp_path, BOUNCE).add(*[arrival[i:i + 40] for i in range(0, 150, 40)])
    feed.add([(-1, "end", at(100_000), False)])
    expected = []
    for k in "abc":
        own = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0]))
        for a, b in zip(own, own[1:] + [None]):
            if a[3] and (b is None or b[3] or b[2] - a[2] >= dt.timedelta(seconds=10)):
                expected.append(a[0])
    found = drain(state.bounces(feed.stream(), "k", "ts", "entry", 10_000, "30 seconds", ["id"]), tmp_path)
    assert sorted(r["id"] for r in found) == sorted(expected)


def test_row_behind_the_watermark_is_left_out(spark, tmp_path):
    feed = Feed(spark, tmp_path, BOUNCE).add([(1, "a", at(0), True)], [(2, "b", at(1000), False)],
                                             [(3, "a", at(5), False)], [(4, "b", at(2000), False)])
    found = drain(state.bounces(feed.stream(), "k", "ts", "entry", 10_000, "2 seconds", ["id"]), tmp_path)
    assert [r["id"] for r in found] == [1]


def test_day_marks_over_batches_equal_batch(spark, tmp_path):
    rng = random.Random(6)
    rows = sorted(((i, rng.choice("abcd"), at(rng.randrange(86400), rng.randrange(40))) for i in range(200)),
                  key=lambda r: r[2])
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp").add(*[rows[i:i + 50] for i in range(0, 200, 50)])
    found = drain(jobs.day_marks(feed.stream(), "k", "ts", ["id"]), tmp_path)
    whole = spark.createDataFrame(rows, "id int, k string, ts timestamp")
    days = keyed.returning(keyed.new_and_daily(keyed.first_times(whole, ["k"], "ts"), "k"), "k")
    expected = sorted((r.k, str(r.date), r.is_first_day, r.is_back) for r in days.collect())
    assert sorted((r["k"], r["day"], r["is_first_day"], r["is_back"]) for r in found) == expected


def rows_in_state(df, tmp_path, name):
    """The most rows that the first stateful operator changed in a micro-batch, and the rows given."""
    given = []
    query = jobs.start(sinks.for_each(df, lambda b, n: given.append(b.count()), str(tmp_path / f"{name}-checkpoint")))
    query.awaitTermination()
    return max(p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators), sum(given)


def test_bounces_and_day_marks_keep_state_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 8)
    users = [(i, f"u{i}", at(i % 50), True) for i in range(2_000)]
    feed = Feed(spark, tmp_path, BOUNCE).add(users, [(-1, "end", at(1_000), False)])
    changed, given = rows_in_state(state.bounces(feed.stream(), "k", "ts", "entry", 10_000, "2 seconds", ["id"]), tmp_path, "bounces")
    assert given == 2_000 and changed <= 200
    for name, delay in (("marks", None), ("timely", "60 seconds")):
        changed, given = rows_in_state(jobs.day_marks(feed.stream(), "k", "ts", ["id"], delay=delay), tmp_path, name)
        assert given == 2_001 and changed <= 200


def test_day_marks_of_rows_without_key_day_or_ties(spark, tmp_path):
    """A null key is a key, a column that is no tie may be null, and large numbers stay exact."""
    big = 2 ** 60 + 1
    feed = Feed(spark, tmp_path, "id long, k string, ts timestamp, n long, m map<string,string>").add(
        [(1, None, at(0), None, {"a": "b"}), (2, None, at(5), 1, None), (3, "x", at(6), big, None)],
        [(4, None, at(0, 9), big, {"c": None}), (5, "x", at(1), None, None)])
    found = drain(jobs.day_marks(feed.stream(), "k", "ts", ["id"], delay="60 days"), tmp_path)
    assert sorted((r["id"], r["k"], r["is_first_day"], r["is_back"], r["n"], r["m"]) for r in found) == [
        (1, None, 1, 0, None, {"a": "b"}), (3, "x", 1, 0, big, None), (4, None, 0, 1, big, {"c": None})]


def test_state_then_window_in_one_query(spark, tmp_path):
    pages = Feed(spark, tmp_path, "common struct<uid:string>, page struct<last_page_id:string>, event_time timestamp")

    def entry(uid, when):
        return ((uid,), (None,), when)
    pages.add([entry("a", at(0)), entry("b", at(3)), entry(None, at(4))], [entry("a", at(5)), entry("c", at(11))],
              [entry("a", at(0, 9)), entry("b", at(1, 1))], [entry("z", at(0, 30))], [entry("z", at(0, 31))])
    found = drain(jobs.login_window(pages.stream(), delay="10 days"), tmp_path)
    assert sorted((r["stt"], r["uu_ct"], r["back_ct"]) for r in found) == [
        ("2024-03-01 12:00:00", 2, 0), ("2024-03-01 12:00:10", 1, 0),
        ("2024-03-02 12:00:00", 1, 0), ("2024-03-10 12:00:00", 1, 1)]


def test_days_are_forgotten_and_still_count_once(spark, tmp_path):
    """A key that is forgotten counts as new again, which daily counts do not use."""
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp").add(
        [(1, "a", at(0)), (2, "a", at(5))], [(3, "a", at(50)), (4, "z", at(0, 3))], [(5, "z", at(60, 3))],
        [(6, "a", at(0, 4)), (7, "a", at(9, 4))])
    found = drain(jobs.day_marks(feed.stream(), "k", "ts", ["id"], delay="60 seconds", keep_ms=86_400_000), tmp_path)
    assert sorted((r["id"], r["is_first_day"]) for r in found) == [(1, 1), (4, 1), (6, 1)]


def test_trade_windows_over_batches_equal_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = sorted((dt.datetime(2024, 3, 1) + dt.timedelta(seconds=rng.randrange(400_000)), f"u{rng.randrange(4)}", str(i))
                  for i in range(80))

    def shop(r):
        return (r[2], r[1], str(int(r[0].timestamp())), f"{r[0]:%Y-%m-%d %H:%M:%S}", "2.50", "0.10", None)
    schema = ("id string, user_id string, ts string, detail_create_time string, split_original_total_amount string, "
              "split_activity_amount string, split_coupon_amount string")
    data = [shop(r) for r in rows]
    feed = Feed(spark, tmp_path, schema).add(*[data[i:i + 30] for i in range(0, 80, 30)])
    whole = spark.createDataFrame(data, schema)
    pay = {"callback_time": F.col("detail_create_time")}
    for name, stream, batch in (
            ("cart", jobs.cart_window(feed.stream(), "1 hour"), trade.cart_window(whole, "1 hour")),
            ("pay", jobs.payment_window(feed.stream().withColumns(pay), "1 hour"),
             trade.payment_window(whole.withColumns(pay), "1 hour")),
            ("order", jobs.order_window(feed.stream(), "1 hour"), trade.order_window(whole, "1 hour"))):
        latest = {r["stt"]: tuple(r.values()) for r in drain(stream, tmp_path, "update", name)}
        assert sorted(latest.values()) == sorted(map(tuple, batch.collect())), name


def test_new_flag_and_toggle_over_batches(spark, tmp_path):
    rng = random.Random(7)
    rows = sorted(((i, rng.choice("abcd"), rng.choice(["0", "1", "1"]), at(rng.randrange(200_000))) for i in range(120)),
                  key=lambda r: (r[3], r[0]))
    schema = "id int, k string, is_new string, ts timestamp"
    feed = Feed(spark, tmp_path, schema).add(*[rows[i:i + 40] for i in range(0, 120, 40)])
    whole = spark.createDataFrame(rows, schema)
    dated = feed.stream().withColumn("day", F.to_date("ts"))
    found = drain(state.new_flag(dated, "k", "ts", "day", "is_new", ["id"]), tmp_path, name="flag")
    assert {r["id"]: r["is_new"] for r in found} == {
        r.id: r.is_new for r in keyed.fix_is_new(whole, "k", "is_new", "ts", ["id"]).collect()}
    found = drain(state.toggle(feed.stream(), ["k"], "ts", ["id"]), tmp_path, name="toggle")
    assert sorted(r["id"] for r in found) == sorted(r.id for r in keyed.toggle(whole, ["k"], "ts", ["id"]).collect())


def test_daily_first_over_batches(spark, tmp_path):
    rows = [(1, "a", at(0)), (2, "a", at(60)), (3, "b", at(60)), (4, "a", at(0, 1)), (5, "b", at(70)), (6, "a", at(9, 1))]
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp").add(rows[:2], rows[2:4], rows[4:])
    found = drain(jobs.daily_first(feed.stream(), ["k"], "ts"), tmp_path)
    assert sorted((r["k"], r["ts"].day) for r in found) == [("a", 1), ("a", 2), ("b", 1)]


def test_latest_after_delay(spark, tmp_path):
    feed = Feed(spark, tmp_path, "id string, v int, page struct<a:string,b:int>").add(
        [("x", 1, ("p", 1)), ("x", 3, ("q", 2)), ("y", 1, ("r", 3))], [("x", 2, ("s", 4))])
    given = []
    query = jobs.start(sinks.for_each(
        state.latest_after_delay(feed.stream(), "id", "v", 3000),
        lambda b, n: given.extend(r.asDict(True) for r in b.collect()), str(tmp_path / "c")), "1 second")
    try:
        end = time.time() + 60
        while len(given) < 2 and time.time() < end:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((r["id"], r["v"], r["page"]["a"]) for r in given) == [("x", 3, "q"), ("y", 1, "r")]


def test_two_inputs(spark, tmp_path):
    orders = Feed(spark, tmp_path, "k string, ts timestamp, o string", "orders")
    details = Feed(spark, tmp_path, "k string, ts timestamp, d int", "details")
    details.add([("a", at(1), 1), ("b", at(1), 2)], [("a", at(20), 3), ("c", at(20), 4)], [("end", at(0, 9), 0)])
    orders.add([("z", at(0), "oz")], [("a", at(10), "oa"), ("c", at(19), "oc")], [("z", at(1, 9), "oz")])
    both = state.two_input(orders.stream(), details.stream(), "k", "ts", "60 seconds", 3_600_000)
    found = drain(both, tmp_path)
    assert sorted((r["k"], r["d"], r["o"] or "") for r in found) == [
        ("a", 1, "oa"), ("a", 3, "oa"), ("b", 2, ""), ("c", 4, "oc")]


def test_stream_interval_join(spark, tmp_path):
    left = Feed(spark, tmp_path, "lk string, lts timestamp", "l").add([("o", at(100))], [("end", at(9000))])
    right = Feed(spark, tmp_path, "rk string, rts timestamp, s int", "r").add(
        [("o", at(94), -6), ("o", at(95), -5), ("x", at(100), 0)], [("o", at(105), 5), ("o", at(106), 6)])
    joined = joins.stream_interval_join(left.stream(), right.stream(), "lk", "rk", "lts", "rts", delay="60 seconds")
    assert sorted(r["s"] for r in drain(joined, tmp_path)) == [-5, 5]


def test_window_counts_in_append_mode(spark, tmp_path):
    pages = Feed(spark, tmp_path, "common struct<vc:string,ch:string,ar:string,is_new:string>, "
                 "page struct<last_page_id:string,during_time:bigint>, event_time timestamp")
    row = ("v", "c", "a", "1")
    pages.add([(row, (None, 5), at(1)), (row, ("home", 7), at(2))], [(row, ("home", 1), at(3)), (row, (None, 2), at(40))],
              [(row, (None, 3), at(41))], [(row, (None, 9), at(4))], [(row, (None, 0), at(400))])
    totals = traffic.page_view_totals(traffic.page_measures(pages.stream()).withWatermark("event_time", "12 seconds"))
    found = drain(totals, tmp_path)
    # The fourth batch is behind the watermark that the second one set.  Spark judges
    # lateness by the watermark of the micro-batch before, hence the third one.
    assert [(r["stt"][-8:], r["pv_ct"], r["sv_ct"], r["dur_sum"]) for r in sorted(found, key=lambda r: r["stt"])] == [
        ("12:00:00", 3, 1, 13), ("12:00:40", 2, 2, 5)]


def test_sliding_distinct_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, "k string, ts timestamp, v string").add(
        [("s", at(0), "o1"), ("s", at(2), "o1")], [("s", at(3), "o2")], [("end", at(900), "x")])
    found = drain(jobs.sliding_distinct(feed.stream(), "ts", ["k"], "v", "6 seconds", "2 seconds", "60 seconds"), tmp_path)
    assert sorted((r["stt"][-8:], r["ct"]) for r in found if r["k"] == "s") == [
        ("11:59:56", 1), ("11:59:58", 2), ("12:00:00", 2), ("12:00:02", 2)]


def test_split_log_stream_into_route_folders(spark, tmp_path):
    def line(mid, day, **more):
        return json.dumps({"common": {"mid": mid, "is_new": "1"}, "ts": 1709290000000 + day * 86_400_000, **more})
    source = tmp_path / "lines"
    source.mkdir()
    for n, lines in enumerate([
            [line("m", 0, page={"page_id": "home"}, displays=[{"i": 1}, {"i": 2}]), "broken {"],
            [line("m", 1, page={"page_id": "home"}, error="E"), line("n", 1, start={"entry": "icon"})]]):
        (source / f"{n}.txt").write_text("\n".join(lines) + "\n")
        os.utime(source / f"{n}.txt", (1_700_000_000 + n,) * 2)
    routed = jobs.split_log(text_stream(spark, str(source), 1))
    out = str(tmp_path / "routes")
    jobs.start(sinks.to_files(routed, out, str(tmp_path / "c")).partitionBy("route")).awaitTermination()
    rows = spark.read.parquet(out)
    assert {r.route: r["count"] for r in rows.groupBy("route").count().collect()} == {
        "page": 2, "display": 2, "error": 1, "start": 1, "dirty": 1}
    flags = rows.where("route = 'page'").select(F.get_json_object("value", "$.common.is_new").alias("f")).collect()
    assert sorted(r.f for r in flags) == ["0", "1"]


# Writers.

def test_upserts_survive_a_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.upsert_batches(path, ["k"], ["v"])
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, s string")
    second = spark.createDataFrame([("b", 0, "late"), ("c", 1, "w")], "k string, v int, s string")
    for batch, df in ((0, first), (1, second), (1, second)):
        write(df, batch)
    expected = [("a", 2, "y"), ("b", 1, "z"), ("c", 1, "w")]
    assert sorted(map(tuple, sinks.read_upserted(spark, path, ["k"], ["v"]).collect())) == expected
    sinks.compact(spark, path, str(tmp_path / "small"), ["k"], ["v"])
    assert sorted(map(tuple, sinks.read_upserted(spark, str(tmp_path / "small"), ["k"], ["v"]).collect())) == expected


def test_append_batches_drop_transient_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, hidden int")
    write = sinks.append_batches(str(tmp_path / "t"), ["hidden"])
    write(df, 0), write(df, 0), write(df, 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect())) == [("a", 0), ("a", 1)]
    assert sinks.positional(df, ["hidden"], 1).columns == ["k"]
    with pytest.raises(ValueError):
        sinks.positional(df, [], 3)


def test_messages(spark):
    row = sinks.as_messages(spark.createDataFrame([("a", 1)], "k string, v int"), ["k"]).first()
    assert (row.key, row.value) == ('{"k":"a"}', '{"k":"a","v":1}')


CHANGES = "table string, type string, ts string, data map<string,string>, old map<string,string>"


def order_changes():
    """Detail before order, order before detail, an update, and late extras."""
    def detail(i, order, ts):
        return ("order_detail", "insert", ts, {"id": i, "order_id": order, "sku_num": "2", "order_price": "1.50",
                                               "source_type": "1"}, None)
    return [
        [detail("d1", "o1", "1"), ("order_info", "insert", "1", {"id": "o2", "user_id": "u2"}, None)],
        [("order_info", "insert", "2", {"id": "o1", "user_id": "u1"}, None), detail("d2", "o2", "2"), detail("d3", "o3", "2")],
        [("order_detail_activity", "insert", "3", {"order_detail_id": "d1", "order_id": "o1", "activity_id": "A"}, None),
         ("order_info", "update", "3", {"id": "o2", "user_id": "u2"}, {"order_status": "1001"}),
         ("cart_info", "insert", "3", {"id": "x"}, None)]]


def test_wide_orders_over_batches_equal_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, CHANGES).add(*order_changes())
    dic = spark.createDataFrame([("1", "search", "")], schemas.DICTIONARY)
    base = str(tmp_path / "wide")
    write = jobs.order_wide_batches(base, lambda s: dic)
    sizes = []

    def counted(df, batch):
        write(df, batch)
        sizes.append(spark.read.parquet(f"{base}/facts/batch_id={batch}").count())
    jobs.start(sinks.for_each(jobs.order_facts(feed.stream()), counted, str(tmp_path / "c"))).awaitTermination()
    facts = spark.read.parquet(f"{base}/facts/batch_id=2")
    write(spark.createDataFrame(facts.collect(), facts.schema), 2)   # a replay
    # Each micro-batch joins the rows of the orders and details that it touches, no more.
    assert sizes == [2, 5, 6]
    kept = sinks.read_upserted(spark, f"{base}/wide", ["id", "type"], ["row_op_ts"])
    log = spark.createDataFrame([r for rows in order_changes() for r in rows], CHANGES)

    def shown(df):
        return sorted((r.id, r.type or "", r.user_id or "", r.activity_id or "", r.split_original_total_amount,
                       r.source_type_name, r.row_op_ts) for r in df.collect() if r.type or r.id == "d3")
    assert shown(kept) == shown(trade.order_wide(log, dic))
    details = trade.latest_details(trade.order_detail(kept))
    assert sorted((r.id, r.activity_id) for r in details.collect()) == [("d1", "A"), ("d2", None)]


def test_dimensions_follow_their_configuration(spark, tmp_path):
    def config(columns):
        return spark.createDataFrame([("sku", "dim_sku", "id", columns, "")], schemas.TABLE_CONFIG)
    current = {"config": config("id,name")}
    base = str(tmp_path / "dims")
    feed = Feed(spark, tmp_path, CHANGES).add([("sku", "insert", "1", {"id": "1", "name": "a", "price": "5"}, None)])

    def run():
        jobs.start(sinks.for_each(feed.stream(), jobs.dimension_batches(base, lambda s: current["config"]),
                                  str(tmp_path / "c"))).awaitTermination()
    run()
    current["config"] = config("id,name,price")
    feed.add([("sku", "update", "2", {"id": "1", "price": "6"}, None), ("other", "insert", "2", {"id": "3"}, None)])
    run()
    table = jobs.read_dimension(spark, base, "dim_sku", "id,name,price", "id")
    assert [tuple(r) for r in table.collect()] == [("1", "a", "6")]
    assert dims.column_list("id,name,price") == table.columns
