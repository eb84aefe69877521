"""Streams that join, remember for a time, and keep tables in place."""

import datetime as dt
import os
import random
import time
import types

import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from tidemart import schemas, sinks
from tidemart.bindings import streams as stream_queries
from tidemart.bindings.registry import QUERIES
from tidemart.operators import dims
from tidemart.operators.changelog import flatten_envelopes
from tidemart.plans import trade, traffic
from tidemart.sinks import tables
from tidemart.sources import handed_over, with_snapshot
from tidemart.streaming import jobs, lookups, state
from test_streams import CHANGES, Feed, T0, at


@pytest.fixture
def by_clock(spark):
    """Micro-batches with new rows only, so that a stream driven by the clock ends."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def run(df, tmp_path, mode="append", name="out"):
    """The rows of the micro-batches that have something to read now."""
    given = []
    jobs.start(sinks.for_each(df, lambda b, n: given.extend(b.collect()), str(tmp_path / f"{name}-c"), mode)).awaitTermination()
    return [r.asDict() for r in given]


# Lookups.

def test_a_dictionary_row_counts_from_the_next_micro_batch(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    spark.createDataFrame([("1", "search", "")], schemas.DICTIONARY).write.parquet(path)
    feed = Feed(spark, tmp_path, CHANGES)
    given = {}
    write = jobs.cart_detail_batches(lookups.table_reader(path, schemas.DICTIONARY),
                                     lambda df, n: given.update({r.id: r.source_type_name for r in df.collect()}))

    def cart(i, code):
        return ("cart_info", "insert", "1", {"id": i, "user_id": "u", "sku_id": "s", "source_type": code, "sku_num": "1"}, None)

    def go():
        jobs.start(sinks.for_each(feed.stream(), write, str(tmp_path / "c"))).awaitTermination()
    feed.add([cart("a", "1"), cart("b", "2")])
    go()
    spark.createDataFrame([("2", "advert", "")], schemas.DICTIONARY).write.mode("append").parquet(path)
    feed.add([cart("c", "2"), cart("d", "3")])
    go()
    assert given == {"a": "search", "b": None, "c": "advert", "d": None}


def test_a_reader_gives_the_latest_row_of_a_key(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], "k string, v int, name string").schema
    read = lookups.table_reader(path, schema, ["k"], ["v"])
    spark.createDataFrame([("a", 1, "old"), ("b", 1, "b")], schema).write.parquet(path)
    assert sorted(r.name for r in read(spark).collect()) == ["b", "old"]
    spark.createDataFrame([("a", 2, "new")], schema).write.mode("append").parquet(path)
    assert sorted(r.name for r in read(spark).collect()) == ["b", "new"]


# Joins in state.

def pairs(spark, tmp_path, **more):
    left = Feed(spark, tmp_path, "k string, l int", "left")
    right = Feed(spark, tmp_path, "rk string, r int", "right")
    return left, right, state.pair_join(left.stream(), right.stream(), "k", "rk", **more)


@pytest.mark.parametrize("salts", [1, 4])
def test_both_orders_of_arrival_join_once(spark, tmp_path, by_clock, salts):
    left, right, joined = pairs(spark, tmp_path, salts=salts)
    left.add([("a", 1), ("a", 2), ("b", 3), (None, 9)])
    right.add([("b", 30), (None, 90)])
    found = run(joined, tmp_path)
    right.add([("a", 10), ("a", 11)])
    left.add([("b", 4)])
    found += run(joined, tmp_path)
    assert sorted((r["k"], r["l"], r["r"], r["matched"]) for r in found) == [
        ("a", 1, 10, 1), ("a", 1, 11, 1), ("a", 2, 10, 1), ("a", 2, 11, 1), ("b", 3, 30, 1), ("b", 4, 30, 1)]


def test_rows_are_forgotten_after_their_time(spark, tmp_path, by_clock):
    left, right, joined = pairs(spark, tmp_path, ttl_ms=3_000, salts=1)
    left.add([("a", 1)])
    right.add([("z", 0)])
    assert run(joined, tmp_path) == []
    time.sleep(3.5)
    left.add([("a", 2)])
    right.add([("a", 10)])
    assert [(r["l"], r["r"]) for r in run(joined, tmp_path)] == [(2, 10)]


def test_a_late_order_corrects_its_refunds(spark, tmp_path, by_clock):
    feed, path = Feed(spark, tmp_path, CHANGES), str(tmp_path / "refunds")
    dictionary = spark.createDataFrame([("1", "money back", "")], schemas.DICTIONARY)

    def refund(i, order):
        return ("order_refund_info", "insert", "5", {"id": i, "user_id": "u", "order_id": order, "refund_type": "1",
                                                     "create_time": "2024-03-01 10:00:00"}, None)
    order = ("order_info", "update", "3", {"id": "o1", "province_id": "7", "order_status": "1005"}, {"order_status": "1002"})
    write = jobs.refund_detail_batches(lambda s: dictionary, path)

    def go():
        jobs.start(sinks.for_each(jobs.refund_detail(feed.stream()), write, str(tmp_path / "c"))).awaitTermination()
        return {r.id: (r.province_id, r.refund_type_name) for r in jobs.read_refunds(spark, path).collect()}
    feed.add([refund("a", "o1"), refund("b", "o2")])
    assert go() == {"a": (None, "money back"), "b": (None, "money back")}
    feed.add([order, refund("c", "o1")])
    assert go() == {"a": ("7", "money back"), "b": (None, "money back"), "c": ("7", "money back")}


def test_first_rows_are_marked(spark, tmp_path, by_clock):
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp")
    marked = state.first_seen(feed.stream(), ["k"], "ts", ["id"])
    feed.add([(1, "a", at(5)), (2, "a", at(1)), (3, "b", at(9))])
    assert sorted((r["id"], r["is_first"]) for r in run(marked, tmp_path)) == [(1, 0), (2, 1), (3, 1)]
    feed.add([(4, "a", at(0)), (5, "c", at(7))])
    assert sorted((r["id"], r["is_first"]) for r in run(marked, tmp_path)) == [(4, 0), (5, 1)]


def test_first_rows_are_forgotten_after_their_time(spark, tmp_path, by_clock):
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp")
    first = state.first_seen(feed.stream(), ["k"], "ts", ["id"], 1_000, only=True)
    feed.add([(1, "a", at(5)), (2, "a", at(1))])
    assert [r["id"] for r in run(first, tmp_path)] == [2]
    time.sleep(1.5)
    feed.add([(3, "a", at(20))])
    assert [r["id"] for r in run(first, tmp_path)] == [3]


def test_versions_in_two_micro_batches_count_once(spark, tmp_path, by_clock):
    schema = "id string, user_id string, sku_id string, v timestamp, detail_create_time string, split_total_amount string"
    feed = Feed(spark, tmp_path, schema)

    def detail(i, v, amount):
        return (i, "u", "s", at(v), f"{T0:%Y-%m-%d %H:%M:%S}", amount)
    totals = jobs.sku_window(feed.stream(), "1 day", "1 day", ["v"], 1_000)
    feed.add([detail("d", 2, "5.00"), detail("e", 1, "1.00")])
    run(totals, tmp_path, "update")
    feed.add([detail("d", 1, "9.00"), detail("e", 3, "2.00")])
    given = run(totals, tmp_path, "update")
    time.sleep(1.5)
    feed.add([detail("later", 1, "100.00")])
    given += run(totals, tmp_path, "update")
    assert (given[-1]["order_count"], float(given[-1]["amount"])) == (2, 7.0)


@pytest.mark.parametrize("expected, error", [(2_000, 1e-6), (200, 0.05)])
def test_a_seen_key_never_passes_and_few_new_ones_are_left_out(spark, tmp_path, expected, error):
    rng = random.Random(9)
    rows = [(i, f"k{rng.randrange(expected)}", at(i)) for i in range(2 * expected)]
    feed = Feed(spark, tmp_path, "id int, k string, ts timestamp").add(*[rows[i::3] for i in range(3)])
    found = run(state.unseen(feed.stream(), ["k"], "ts", ["id"], expected, error), tmp_path)
    keys, given = {r[1] for r in rows}, [r["k"] for r in found]
    assert len(given) == len(set(given)) and set(given) <= keys
    assert len(keys) - len(given) <= max(0 if error < 0.01 else 1, 2 * error * len(keys))


def test_size_of_the_filter():
    assert state.filter_size(1_000_000, 0.01) == (293, 7)
    assert state.filter_size(1, 0.5) == (1, 1)


# Keys dealt to buckets.

class Handle:
    """State lists without a store."""

    def getListState(self, name, schema, ttl=None):
        held = []
        return types.SimpleNamespace(exists=lambda: bool(held), get=lambda: iter(held), appendValue=held.append,
                                     appendList=held.extend)


def chunk(keys, **columns):
    return Row(_bucket=0, _rows=state._chunk(pa.table({**columns, "_key": pa.array([k * 16 for k in keys], pa.binary())})))


def test_first_rows_of_several_chunks():
    first = state.FirstSeen(["ts"], 1_000, False)
    first.init(Handle())

    def go(*chunks):
        out = [state._rows(r[0]) for r in first.handleInputRows((0,), iter(chunks), None)]
        return sorted((r["id"], r["is_first"]) for t in out for r in t.to_pylist())
    assert go(chunk([b"a", b"a", b"b"], id=[1, 2, 3], ts=[5, 4, 9]), chunk([b"a", b"b"], id=[4, 5], ts=[3, 9]),
              chunk([b"a", b"c"], id=[6, 7], ts=[6, 1])) == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (6, 0), (7, 1)]
    assert go(chunk([b"c", b"d"], id=[8, 9], ts=[0, 0])) == [(8, 0), (9, 1)]


@pytest.mark.parametrize("job", ["first", "latest", "pairs", "facts", "flag"])
def test_state_is_kept_by_buckets_of_keys(spark, tmp_path, by_clock, job):
    """So that the calls to the state store do not grow with the keys."""
    rows = spark.range(20_000).select(
        F.nullif(F.col("id"), F.lit(7)).cast("string").alias("k"), "id", F.lit(at(0)).cast("timestamp").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    df = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    made = {
        "first": lambda: state.first_seen(df, ["k"], "ts", ["id"]),
        "latest": lambda: state.latest_after_delay(df, "k", "id", 1),
        "pairs": lambda: state.pair_join(df.select("k", "id"), df.select(F.col("k").alias("rk"), "ts"), "k", "rk", salts=1),
        "facts": lambda: state.touched_facts(df.select("k", F.lit("c").alias("_child"), F.col("id").cast("string")), "k"),
        "flag": lambda: state.new_flag(df.select("k", "ts", F.to_date("ts").alias("day"), F.lit("1").alias("f")), "k", "ts", "day", "f")}
    given = []
    query = jobs.start(sinks.for_each(made[job](), lambda b, n: given.append(b.count()), str(tmp_path / "c")))
    query.awaitTermination()
    assert 0 < query.lastProgress.stateOperators[0].numRowsUpdated <= 3 * state.BUCKETS
    assert sum(given) == {"first": 20_000, "latest": 0, "pairs": 19_999, "facts": 20_000, "flag": 20_000}[job]


def test_salts_deal_the_same_number_of_buckets(spark, tmp_path, by_clock):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), "id")
    rows.write.parquet(str(tmp_path / "in"))
    df = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    joined = state.pair_join(df, df.select(F.col("k").alias("rk"), F.col("id").alias("other")), "k", "rk", salts=4)
    given = []
    query = jobs.start(sinks.for_each(joined, lambda b, n: given.append(b.count()), str(tmp_path / "c")))
    query.awaitTermination()
    assert given == [20_000] and 0 < query.lastProgress.stateOperators[0].numRowsUpdated <= 3 * state.BUCKETS


def test_first_rows_are_found_over_many_small_chunks(monkeypatch):
    monkeypatch.setattr(state, "_MOST_ROWS", 4)
    rows = [(b"%d" % (i % 3), 100 - i % 50, i) for i in range(99)]
    table = pa.table({"_key": pa.array([r[0] for r in rows]), "v": [r[1] for r in rows], "id": [r[2] for r in rows]})
    best = state._firsts([table.slice(i, 2) for i in range(0, 99, 2)], ["_key"], [("v", "ascending")])
    wanted = {k: min((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])) for k in (b"0", b"1", b"2")}
    assert sorted(zip(*best.to_pydict().values())) == sorted(wanted.values())


# The traffic window.

def test_late_bounces_reach_the_window(spark, tmp_path):
    schema = ("common struct<mid:string,vc:string,ch:string,ar:string,is_new:string>, "
              "page struct<last_page_id:string,during_time:bigint>, event_time timestamp")
    feeds = [Feed(spark, tmp_path, schema, name) for name in ("pages", "uv", "uj")]

    def row(mid, last, s):
        return ((mid, "v", "c", "a", "1"), (last, 5), at(s))
    pages, uv, uj = feeds
    pages.add([row("m", None, 1), row("n", None, 2)])
    uv.add([row("m", None, 1), row("n", None, 2)])
    uj.add([])
    totals = jobs.page_view_window(*[f.stream() for f in feeds], size="10 seconds", delay="2 seconds")
    run(totals, tmp_path, "update")
    pages.add([row("m", "home", 500)], [row("m", "home", 900)])
    run(totals, tmp_path, "update")
    uj.add([row("n", None, 2)])   # judged long after the pages have gone on
    given = {r["stt"][-8:]: r for r in run(totals, tmp_path, "update")}
    first = given["12:00:00"]
    assert (first["uv_ct"], first["sv_ct"], first["pv_ct"], first["uj_ct"]) == (2, 2, 2, 1)
    assert set(first) == {"stt", "edt", *traffic.VISIT_KEYS, *traffic.MEASURES}


# Tables in place.

def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_ten_micro_batches_with_a_replay(spark, tmp_path):
    rng, path = random.Random(3), str(tmp_path / "t")
    batches = [[(f"k{rng.randrange(40)}", rng.randrange(6), f"{n}-{i}") for i in range(25)] for n in range(10)]
    write, latest = tables.keyed_table_batches(path, ["k"], ["v"], parts=8), {}
    for n, rows in enumerate(batches):
        rows = list({(k, v): (k, v, s) for k, v, s in rows}.values())   # versions of a key differ inside a micro-batch
        write(spark.createDataFrame(rows, "k string, v int, s string"), n)
        if n in (4, 9):
            write(spark.createDataFrame(rows, "k string, v int, s string"), n)
        for k, v, s in rows:
            latest[k] = max(latest.get(k, (-1, -1, "")), (v, n, s))
    found = {r.k: (r.v, r.s) for r in tables.read_table(spark, path).collect()}
    assert found == {k: (v, s) for k, (v, _, s) in latest.items()}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    write = tables.keyed_table_batches(path, ["k"], ["v"], parts=16)
    write(spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    before = files_of(f"{path}/table")
    write(spark.createDataFrame([(7, 2)], "k long, v int"), 1)
    after = files_of(f"{path}/table")
    assert len({os.path.dirname(f) for f in before ^ after}) == 1 and len(before & after) >= 10
    assert tables.read_table(spark, path).where("v = 2").count() == 1 and tables.read_table(spark, path).count() == 200


def test_a_micro_batch_is_merged_by_size_whatever_its_session_has(spark, tmp_path):
    names, seen = ("spark.sql.adaptive.enabled", "spark.sql.maxConcurrentOutputFileWriters"), []
    own = spark.newSession()
    own.conf.set(names[0], "false")

    def merge(rows):
        seen.append([rows.sparkSession.conf.get(n) for n in names])
        return rows
    tables.merged_batches(str(tmp_path / "t"), ["k"], merge, 4)(own.createDataFrame([(1, 1)], "k long, v int"), 0)
    assert seen == [["true", "4"]] and own.conf.get(names[0]) == "false" and own.conf.get(names[1]) == "0"


def test_keyed_upsert_joins_its_details_once(spark, monkeypatch):
    plans = []

    def recorded(path, keys, version):
        write = sinks.upsert_batches(path, keys, version)

        def run(df, batch):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            write(df, batch)
        return run
    monkeypatch.setattr(stream_queries, "upsert_batches", recorded)
    assert QUERIES["keyed_upsert"](spark, "/root/testdata/sf0.001").count()
    assert len(plans) == 3 and not any("Join" in p for p in plans)


def test_a_failure_between_both_steps_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    tables.keyed_table_batches(path, ["k"], ["v"], 2)(rows, 0)
    part = next(d for d in os.listdir(f"{path}/table") if d.startswith("part="))
    for f in files_of(f"{path}/table/{part}"):
        os.remove(f)   # the step that puts partitions in place was cut off
    tables.keyed_table_batches(path, ["k"], ["v"], 2)(rows, 0)
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == ["a", "b"]


def test_a_configuration_row_creates_its_table_while_running(spark, tmp_path):
    name = f"dim_made_{os.getpid()}"
    config, base = [("sku", f"{name}_a", "id", "id,name", "")], str(tmp_path / "dims")
    feed = Feed(spark, tmp_path, CHANGES)
    write = jobs.dimension_table_batches(base, lambda s: s.createDataFrame(config, schemas.TABLE_CONFIG), parts=4, catalog=True)

    def go():
        jobs.start(sinks.for_each(feed.stream(), write, str(tmp_path / "c"))).awaitTermination()
    try:
        feed.add([("sku", "insert", "1", {"id": "1", "name": "a", "price": "5"}, None), ("spu", "insert", "1", {"spu": "s"}, None)])
        go()
        assert not spark.catalog.tableExists(f"{name}_b")
        config[0] = ("sku", f"{name}_a", "id", "id,name,price", "")
        config.append(("spu", f"{name}_b", "spu", "spu", None))
        feed.add([("sku", "update", "2", {"id": "1", "price": "6"}, None), ("sku", "insert", "2", {"name": "no key"}, None),
                  ("spu", "insert", "2", {"spu": "t"}, None)])
        go()
        assert [tuple(r) for r in spark.table(f"{name}_a").select("id", "name", "price").collect()] == [("1", "a", "6")]
        assert [r.spu for r in spark.table(f"{name}_b").collect()] == ["t"]
        table = jobs.read_dimension_table(spark, base, f"{name}_a", "id,name,price", "id")
        assert [tuple(r) for r in table.collect()] == [("1", "a", "6")]
    finally:
        for suffix in "ab":
            spark.sql(f"DROP TABLE IF EXISTS {name}_{suffix}")


def test_cells_keep_what_a_change_does_not_carry(spark):
    routed = spark.createDataFrame(
        [("id", {"id": "1", "a": "x", "b": "y"}, 1), ("id", {"id": "1", "a": None}, 3), ("id", {"id": "1", "a": "old"}, 2),
         ("id", {"a": "keyless"}, 9)], "sink_pk string, data map<string,string>, ts int")
    rows = dims.merged_cells(dims.cells(routed, ["ts"]).withColumn("part", F.lit(0)), ["part"])
    assert [tuple(r) for r in dims.wide(rows, ["id", "a", "b"]).collect()] == [("1", None, "y")]


def test_changes_up_to_the_snapshot_do_not_come_again(spark, tmp_path):
    folder = str(tmp_path / "changes")
    schema = ("before map<string,string>, after map<string,string>, source struct<table:string>, op string, position long")
    rows = [({}, {"id": "1", "v": "before"}, ("t",), "u", 5), ({"id": "2"}, None, ("t",), "d", 10), ({}, {"id": "1", "v": "after"}, ("t",), "u", 11)]
    spark.createDataFrame(rows, schema).write.parquet(folder)
    with_snapshot(spark, spark.createDataFrame([(1, "taken"), (2, "taken")], "id int, v string"), "t", folder, "position", 10)
    left = flatten_envelopes(handed_over(spark.read.parquet(folder), "position", 10), ["position"])
    assert sorted((r.type, r.after["id"], r.after["v"], r.position) for r in left.collect()) == [
        ("bootstrap-insert", "1", "taken", 10), ("bootstrap-insert", "2", "taken", 10), ("update", "1", "after", 11)]


def test_spu_rows_add_up_skus(spark):
    totals = spark.createDataFrame([("s", "e", "u", "k1", 1, 2), ("s", "e", "u", "k2", 2, 3)],
                                   "stt string, edt string, user_id string, sku_id string, order_count long, amount int")
    names = {c: "x" for c in (*trade.CATALOG, "spu_id", "spu_name")}
    catalog = spark.createDataFrame([("k1",), ("k2",)], "sku_id string").select("sku_id", *[F.lit(v).alias(c) for c, v in names.items()])
    row = trade.spu_rows(totals.withColumn("amount", F.col("amount").cast("decimal(16,2)")), catalog).collect()
    assert [(r.order_count, r.order_amount) for r in row] == [(3, 5.0)]
    assert dt.datetime(2024, 3, 1, 12) == T0


def test_results_carry_the_time_of_their_computation(spark, tmp_path):
    path, before = str(tmp_path / "t"), time.time() * 1000
    sinks.upsert_batches(path, ["k"], stamp=True)(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    row = sinks.read_upserted(spark, path, ["k"], ["ts"]).first()
    assert row.v == 1 and before - 1_000 <= row.ts <= time.time() * 1000 + 1_000


def test_rows_reach_their_bucket_as_chunks_by_one_shuffle(spark, tmp_path):
    feed = Feed(spark, tmp_path, "k string, at timestamp")
    plan = state.first_seen(feed.stream(), ["k"], "at")._jdf.queryExecution().logical().toString()
    assert "MapInArrow" in plan and "Repartition" not in plan


def test_chunks_are_read_as_they_were_written_and_small():
    rows = pa.table({f"c{n}": [f"{n} {i % 7}" for i in range(300)] for n in range(20)}).slice(10, 200)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    assert state._rows(state._chunk(rows)).equals(rows) and len(state._chunk(rows)) < sink.getvalue().size / 2
    assert state._rows(state._chunk(rows.slice(0, 0))).num_rows == 0


def test_rows_as_they_came_are_kept_until_they_are_merged(spark, tmp_path, monkeypatch):
    hints, path = [], str(tmp_path / "t")
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    hint = type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda df, name, *args: hints.append(name) or hint(df, name, *args))
    tables.keyed_table_batches(path, ["k"], ["v"], 4)(rows, 0)
    assert os.listdir(f"{path}/_main/batch_id=0") == ["merged"] and not hints
    assert tables.read_table(spark, path).count() == 20


def test_facts_of_a_micro_batch_are_deleted_after_the_next(spark, tmp_path):
    image = ", ".join(f"{c}: string" for c in trade.WIDE_FIELDS)
    facts = spark.createDataFrame([], "order_key string, table string, type string, ts string, "
                                      f"data struct<{image}>, old map<string,string>")
    write = jobs.order_wide_batches(str(tmp_path), lambda s: s.createDataFrame([], "dic_code string, dic_name string"))
    write(facts, 0)
    write(facts, 1)
    assert os.listdir(tmp_path / "facts") == ["batch_id=1"] and len(os.listdir(tmp_path / "wide")) == 2
