"""Stateful processors, for what no built-in streaming operator expresses.

All rows of a key in one micro-batch meet in one task, sorted by event time there.
What bounds them is the size of a micro-batch, so set ``maxOffsetsPerTrigger`` or
``maxFilesPerTrigger`` on the source.  State sits in the state store and is kept
small: a date, a flag, one row, or the rows still waiting for the watermark.

A call from Python to the state store costs as much as hundreds of rows, and a row that passes
Python alone as much as dozens in an Arrow batch.  So jobs with as many keys as rows deal their
keys to buckets (:func:`by_bucket`): rows of a bucket come and go as Arrow chunks, and its state is
a list of such chunks, to which a micro-batch adds.
"""

from __future__ import annotations

import datetime
import math
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

# Processors travel with the query, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _millis(ts: datetime.datetime) -> int:
    return int(ts.timestamp() * 1_000_000) // 1000


def _plain(value):
    """Rows as tuples at every depth, which is the form that state takes."""
    if isinstance(value, tuple):
        return tuple(_plain(v) for v in value)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def _with(schema: T.StructType, **added: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(n, k) for n, k in added.items()])


BUCKETS = 1_024
_KEY = 16
_SIZE = 8
_MOST_ROWS = 250_000
_MOST_BYTES = 64 << 20


def _chunk(rows: pa.Table) -> bytes:
    """The rows and their schema, compressed as one; the first bytes are the size before that."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    whole = sink.getvalue()
    return whole.size.to_bytes(_SIZE, "little") + pa.Codec("zstd").compress(whole, asbytes=True)


def _rows(chunk: bytes) -> pa.Table:
    size = int.from_bytes(chunk[:_SIZE], "little")
    return pa.ipc.open_stream(pa.Codec("zstd").decompress(memoryview(chunk)[_SIZE:], size)).read_all()


def _gathered(tables: Iterable[pa.Table], most_rows: int = _MOST_ROWS) -> Iterator[pa.Table]:
    """The same rows in fewer tables of bounded size."""
    held, rows, size = [], 0, 0
    for table in tables:
        held.append(table)
        rows, size = rows + table.num_rows, size + table.nbytes
        if rows >= most_rows or size >= _MOST_BYTES:
            yield pa.concat_tables(held).combine_chunks()
            held, rows, size = [], 0, 0
    if rows:
        yield pa.concat_tables(held).combine_chunks()


def _to_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _gathered((pa.Table.from_batches([b]) for b in batches), 4 * _MOST_ROWS):
        table = table.take(pa.compute.sort_indices(table["_bucket"])).combine_chunks()
        buckets, rows = table["_bucket"].to_numpy(), table.drop_columns(["_bucket"])
        starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
        chunks = [_chunk(rows.slice(i, n)) for i, n in zip(starts, np.diff(np.r_[starts, len(buckets)]))]
        yield pa.RecordBatch.from_arrays([pa.array(buckets[starts], pa.int32()), pa.array(chunks, pa.binary())],
                                         ["_bucket", "_rows"])


def _from_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _gathered(_rows(c.as_py()) for b in batches for c in b["_rows"]):
        yield from table.to_batches()


def by_bucket(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, out: T.StructType,
              salt: Sequence[str] = (), salts: int = 1, mode: str = "ProcessingTime", ts: str | None = None) -> DataFrame:
    """Run a processor of chunks on a stream, by default with timers or a time to live by the clock.

    With ``ts`` the processor gives pandas frames, of which this column keeps the event time; a
    stream has one watermark, and chunks would lose it.

    Its chunks hold the columns of ``df`` and ``_key``: 128 bits of hash that stand for the key, of
    which null is a value.  ``salt`` names a column of numbers below ``salts`` that deals a key further,
    into as many buckets in all.
    """
    parts = [c for k in keys for c in (F.col(k).isNull(), F.col(k))]
    first, second = (F.xxhash64(F.lit(n), *parts) for n in (1, 2))
    text = F.concat(*[F.lpad(F.hex(h), _KEY, "0") for h in (first, second)])
    bucket = F.pmod(first, F.lit(max(1, BUCKETS // salts))).cast("int") * salts
    dealt = df.withColumns({"_bucket": sum([F.col(c) for c in salt], bucket).cast("int"), "_key": F.unhex(text)})
    # Chunks are made where the rows are read, so that only they are shuffled.
    chunks = dealt.mapInArrow(_to_chunks, "_bucket int, _rows binary")
    if ts:
        return chunks.groupBy("_bucket").transformWithStateInPandas(processor, out, "append", mode, eventTimeColumnName=ts)
    done = chunks.groupBy("_bucket").transformWithState(processor, "_rows binary", "append", mode)
    return done.mapInArrow(_from_chunks, out)


def _firsts(tables: Iterable[pa.Table], keys: Sequence[str], order: Sequence[tuple[str, str]]) -> pa.Table | None:
    """The first row of each key.  Of a busy key no more rows are held than its chunks are large."""
    held, rows, kept = [], 0, 0
    for table in tables:
        held.append(table)
        rows += table.num_rows
        if rows - kept >= max(kept, _MOST_ROWS):
            held = [_first_rows(pa.concat_tables(held), keys, order)]
            rows = kept = held[0].num_rows
    return _first_rows(pa.concat_tables(held), keys, order) if held else None


def _first_rows(table: pa.Table, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> pa.Table:
    # The place of a row, last, makes equal rows keep their order.
    by = table.select([*keys, *[c for c, _ in order]]).append_column("_state_place", pa.array(range(table.num_rows), pa.int64()))
    at = pa.compute.sort_indices(by, sort_keys=[*[(k, "ascending") for k in keys], *order, ("_state_place", "ascending")])
    if table.num_rows < 2:
        return table
    sorted_ = by.select(keys).take(at).combine_chunks()
    new = np.zeros(table.num_rows - 1, bool)
    for k in keys:
        column = sorted_[k].combine_chunks() if isinstance(sorted_[k], pa.ChunkedArray) else sorted_[k]
        new |= pa.compute.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return table.take(at.filter(pa.array(np.r_[True, new])))


def _sorted(table: pa.Table, order: Sequence[str]) -> pa.Table:
    """Rows by key and order; equal ones keep theirs."""
    by = table.select(["_key", *order]).append_column("_state_place", pa.array(np.arange(table.num_rows)))
    return table.take(pa.compute.sort_indices(by, sort_keys=[(c, "ascending") for c in by.column_names])).combine_chunks()


def _frame(rows: pa.Table):
    """The rows in pandas, whole numbers exact beside nulls."""
    return rows.to_pandas(integer_object_nulls=True, maps_as_pydicts="strict")


def _same_as_next(keys: pa.ChunkedArray) -> np.ndarray:
    """Of sorted keys, those that the next row has as well."""
    keys = keys.combine_chunks()
    if isinstance(keys, pa.ChunkedArray):
        keys = pa.concat_arrays(keys.chunks) if keys.num_chunks else pa.array([], keys.type)
    same = pa.compute.equal(keys.slice(0, max(len(keys) - 1, 0)), keys.slice(1)).to_numpy(zero_copy_only=False)
    return np.append(same, False)[:len(keys)].astype(bool)


def _times(rows: pa.Table, ts: str) -> np.ndarray:
    """Event times in milliseconds."""
    return rows[ts].cast(pa.timestamp("us", rows[ts].type.tz)).cast(pa.int64()).to_numpy() // 1000


class _Timed(StatefulProcessor):
    """Common part of buckets with event time: one timer a bucket, for what is due first."""

    def init(self, handle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "at bigint")

    def _wake(self, at: int) -> None:
        if self.due.exists():
            before = self.due.get()[0]
            if before <= at:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)
        self.due.update((at,))

    def close(self) -> None:
        pass


def _pairs(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[pa.Array, pa.Array]:
    """Places of all pairs of equal keys."""
    sides = [pa.table({"_key": keys, name: pa.array(range(len(keys)), pa.int64())}) for keys, name in ((left, "_l"), (right, "_r"))]
    joined = sides[0].join(sides[1], "_key", join_type="inner", use_threads=False)
    return joined["_l"], joined["_r"]


def _listed(state) -> Iterator[tuple]:
    return state.get() if state.exists() else iter(())


class _Ordered(StatefulProcessor):
    """Common part: rows of a key come sorted by event time and tie-breakers."""

    def __init__(self, ts: str, ties: Sequence[str] = ()):
        self.order = [ts, *ties]

    def sorted(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: tuple(r[c] for c in self.order))

    def close(self) -> None:
        pass


class DayMarks(_Timed):
    """First row of each key and day, marked if it is the key's first day ever or
    comes more than ``gap`` days after its last day.

    As in a stream of single records, only the last day is remembered: an earlier
    day that arrives late counts as a new one.  A bucket holds the last days of its keys in one
    chunk.  Rows without a day are left out.
    """

    def __init__(self, ts: str, day: str, ties: Sequence[str] = (), gap: int = 7,
                 timely: bool = False, keep_ms: int | None = None):
        self.order, self.day, self.gap, self.timely, self.keep = [ts, *ties], day, gap, timely, keep_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "rows binary")

    def _known(self) -> pa.Table:
        """The last day of each key and when it came."""
        if self.last.exists():
            return _rows(self.last.get()[0])
        return pa.table({"_key": pa.array([], pa.binary()), "day": pa.array([], pa.string()), "at": pa.array([], pa.int64())})

    def handleInputRows(self, key, rows, timerValues):
        known = self._known().combine_chunks()
        now = timerValues.getCurrentWatermarkInMs() if self.timely else None
        # Only the first row of each day is held, so a busy key costs as much as it has days.
        # Rows, or with event time pandas frames of rows.
        chunks = (chunk for frame in rows for chunk in frame.iloc[:, 1]) if self.timely else (row[1] for row in rows)
        new = (self._new(table, known, now) for table in _gathered(_rows(chunk) for chunk in chunks))
        first = _firsts(new, ["_key", self.day], [(c, "ascending") for c in self.order])
        if first is None or not first.num_rows:
            return
        first = _sorted(first, self.order)
        goes_on, days = _same_as_next(first["_key"]), first[self.day].cast(pa.string()).combine_chunks()
        starts = np.append(True, ~goes_on[:-1])
        days = pa.concat_arrays(days.chunks) if isinstance(days, pa.ChunkedArray) else days
        held = known["day"].take(pa.compute.index_in(first["_key"], known["_key"]))
        within = pa.concat_arrays([pa.nulls(1, pa.string()), days.slice(0, len(days) - 1)])
        before = pa.chunked_array([pa.compute.if_else(pa.array(starts), held.combine_chunks(), within)])
        none = before.is_null().to_numpy()
        back = np.zeros(len(days), np.int64)
        dated = pa.array(~none)
        apart = [c.filter(dated).cast(pa.date32()).cast(pa.int32()).to_numpy() for c in (pa.chunked_array([days]), before)]
        back[~none] = apart[0] - apart[1] > self.gap
        marked = first.drop_columns(["_key"]).append_column("is_first_day", pa.array(none.astype(np.int64)))
        marked = marked.append_column("is_back", pa.array(back))
        ends = pa.array(~goes_on)
        latest = pa.table({"_key": first["_key"].cast(pa.binary()), "day": days, "at": _times(first, self.order[0])}).filter(ends)
        others = known.filter(pa.compute.invert(pa.compute.is_in(known["_key"], latest["_key"])))
        self.last.update((_chunk(pa.concat_tables([others, latest])),))
        if self.keep is not None:
            self._wake(pa.compute.min(latest["at"]).as_py() + self.keep)
        for i in range(0, marked.num_rows, _MOST_ROWS):
            part = marked.slice(i, _MOST_ROWS)
            yield _frame(part) if self.timely else Row(_rows=_chunk(part))

    def _new(self, rows: pa.Table, known: pa.Table, now: int | None) -> pa.Table:
        """Rows in time whose day is not the last one of their key."""
        if now is not None:
            rows = rows.filter(pa.array(_times(rows, self.order[0]) >= now))
        last = known["day"].take(pa.compute.index_in(rows["_key"], known["_key"]))
        other = pa.compute.fill_null(pa.compute.not_equal(rows[self.day], last), True)
        return rows.filter(pa.compute.and_(other, rows[self.day].is_valid()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.due.clear()
        known = self._known()
        left = known.filter(pa.compute.greater(known["at"], timerValues.getCurrentWatermarkInMs() - self.keep))
        if left.num_rows:
            if left.num_rows < known.num_rows:
                self.last.update((_chunk(left),))
            self._wake(pa.compute.min(left["at"]).as_py() + self.keep)
        else:
            self.last.clear()
        return iter(())


def day_marks(df: DataFrame, keys: str | Sequence[str], ts: str, day: str,
              ties: Sequence[str] = (), gap: int = 7, delay: str | None = None,
              keep_ms: int | None = None) -> DataFrame:
    """Adds ``is_first_day`` and ``is_back``; ``day`` is a ``yyyy-MM-dd`` text column.

    With a ``delay`` the result keeps its event time, so that a window can follow in
    the same query: rows come out at once, and rows behind the watermark are left out.
    ``keep_ms`` after its last counted row a key is forgotten; a day or more is enough
    to count each key once a day, while the marks need the days for ever.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if keep_ms is not None and delay is None:
        raise ValueError("forgetting keys needs a watermark delay")
    out = _with(df.schema, is_first_day=T.LongType(), is_back=T.LongType())
    if delay is None:
        return by_bucket(df, keys, DayMarks(ts, day, ties, gap), out, mode="None")
    marks = DayMarks(ts, day, ties, gap, True, keep_ms)
    return by_bucket(df.withWatermark(ts, delay), keys, marks, out, mode="EventTime", ts=ts)


class NewFlag(StatefulProcessor):
    """Keeps a new-visitor flag only on the day of a key's first row.

    The first micro-batch of a key has to be seen whole, so that of a bucket is gone through twice.
    State adds the first days of new keys.
    """

    def __init__(self, ts: str, day: str, flag: str, ties: Sequence[str] = ()):
        self.order, self.day, self.flag = [ts, *ties], day, flag

    def init(self, handle) -> None:
        self.anchors = handle.getListState("anchors", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        chunks, none = [row[1] for row in rows], pa.table({"_key": pa.array([], pa.binary()), "anchor": pa.array([], pa.int32())})
        known = pa.concat_tables([none, *[_rows(chunk) for (chunk,) in _listed(self.anchors)]])
        columns = list(dict.fromkeys(["_key", self.day, self.flag, *self.order]))
        unknown = (t.filter(pa.compute.invert(pa.compute.is_in(t["_key"], known["_key"])))
                   for t in _gathered(_rows(chunk).select(columns) for chunk in chunks))
        first = _firsts(unknown, ["_key"], [(c, "ascending") for c in self.order])
        if first is not None and first.num_rows:
            # A first row without the flag means the visitor came before that day.
            earlier = pa.compute.if_else(self._flagged(first), 0, 1)
            days = pa.compute.subtract(first[self.day].cast(pa.int32()), earlier.cast(pa.int32()))
            new = pa.table({"_key": first["_key"].cast(pa.binary()), "anchor": days})
            self.anchors.appendValue((_chunk(new),))
            known = pa.concat_tables([known, new])
        known = known.combine_chunks()
        for table in _gathered(_rows(chunk) for chunk in chunks):
            anchor = known["anchor"].take(pa.compute.index_in(table["_key"], known["_key"]))
            stale = pa.compute.fill_null(pa.compute.not_equal(table[self.day].cast(pa.int32()), anchor), True)
            flags = pa.compute.if_else(pa.compute.and_(self._flagged(table), stale), "0", table[self.flag])
            place = table.column_names.index(self.flag)
            table = table.set_column(place, self.flag, flags.cast(table[self.flag].type))
            yield Row(_rows=_chunk(table.drop_columns(["_key"])))

    def _flagged(self, rows: pa.Table) -> pa.ChunkedArray:
        return pa.compute.fill_null(pa.compute.equal(rows[self.flag], "1"), False)

    def close(self) -> None:
        pass


def new_flag(df: DataFrame, key: str, ts: str, day: str, flag: str,
             ties: Sequence[str] = ()) -> DataFrame:
    return by_bucket(df, [key], NewFlag(ts, day, flag, ties), df.schema, mode="None")


class Bounces(_Timed):
    """Entry rows that no other page follows within a time span.

    Rows wait until the watermark is ``within`` past them, because only then all rows
    that could follow them have come.  Rows are judged in event-time order, however
    they arrived.  Of a bucket of keys, each micro-batch adds its rows as chunks; those that are
    due are judged at once.
    """

    def __init__(self, ts: str, entry: str, within_ms: int, ties: Sequence[str] = ()):
        self.order, self.entry, self.within = [ts, *ties], entry, within_ms

    def init(self, handle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "rows binary")

    def _wait(self, tables: Iterable[pa.Table]) -> Iterator[tuple[bytes]]:
        """Chunks for the state; sees to it that they are judged."""
        first = None
        for rows in tables:
            if rows.num_rows:
                at = int(_times(rows, self.order[0]).min())
                first = at if first is None else min(first, at)
                for i in range(0, rows.num_rows, _MOST_ROWS):
                    yield (_chunk(rows.slice(i, _MOST_ROWS)),)
        if first is not None:
            self._wake(first + self.within)

    def handleInputRows(self, key, rows, timerValues):
        # What came before the watermark may have been judged already: such rows are late.
        now = timerValues.getCurrentWatermarkInMs()
        tables = _gathered(_rows(row[1]) for row in rows)
        for chunk in self._wait(t.filter(pa.array(_times(t, self.order[0]) >= now)) for t in tables):
            self.waiting.appendValue(chunk)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        self.due.clear()
        rows = _sorted(pa.concat_tables([_rows(chunk) for (chunk,) in _listed(self.waiting)]), self.order)
        at = _times(rows, self.order[0])
        done = at + self.within <= now
        entry = pa.compute.fill_null(rows[self.entry], False).to_numpy()
        follows = _same_as_next(rows["_key"]) & (np.diff(at, append=0) < self.within) & ~np.append(entry[1:], True)
        left = list(self._wait([rows.filter(pa.array(~done))]))
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        out = rows.filter(pa.array(done & entry & ~follows)).drop_columns(["_key"])
        for i in range(0, out.num_rows, _MOST_ROWS):
            yield Row(_rows=_chunk(out.slice(i, _MOST_ROWS)))


def bounces(df: DataFrame, key: str, ts: str, entry: str, within_ms: int, delay: str,
            ties: Sequence[str] = ()) -> DataFrame:
    """``entry`` is a boolean column.  Rows still waiting when a stream ends come out
    once later rows move the watermark.

    Emitted rows are older than the watermark: window them in a second query that
    reads this one's output with a delay above ``within`` plus this delay.
    """
    return by_bucket(df.withWatermark(ts, delay), [key], Bounces(ts, entry, within_ms, ties), df.schema, mode="EventTime")


class LatestAfterDelay(StatefulProcessor):
    """Gives the row with the highest version a fixed time after a key's first row.

    Of a bucket of keys, each micro-batch adds the best rows of its keys and when they are due; the
    first of a key says when the best of all of them comes out.
    """

    def __init__(self, version: Sequence[str], delay_ms: int):
        self.version, self.delay = list(version), delay_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "due bigint, rows binary")

    def _best(self, tables: Iterable[pa.Table]) -> pa.Table:
        """The best row of each key; of equal ones the first."""
        return _firsts(tables, ["_key"], [(c, "descending") for c in self.version])

    def handleInputRows(self, key, rows, timerValues):
        due = timerValues.getCurrentProcessingTimeInMs() + self.delay
        best = self._best(_gathered(_rows(r[1]) for r in rows))
        self.waiting.appendList([(due, _chunk(best.slice(i, _MOST_ROWS))) for i in range(0, best.num_rows, _MOST_ROWS)])
        self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = [(due, _rows(chunk)) for due, chunk in _listed(self.waiting)]
        due_keys = [rows["_key"] for due, rows in held if due <= now]
        if not due_keys:
            return
        done = pa.chunked_array([c for keys in due_keys for c in keys.chunks], pa.binary())
        ready, left = [], []
        for due, rows in held:
            out = pa.compute.is_in(rows["_key"], done)
            ready.append(rows.filter(out))
            rows = rows.filter(pa.compute.invert(out))
            if rows.num_rows:
                left.append((due, _chunk(rows)))
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        best = self._best(ready).drop_columns(["_key"])
        for i in range(0, best.num_rows, _MOST_ROWS):
            yield Row(_rows=_chunk(best.slice(i, _MOST_ROWS)))

    def close(self) -> None:
        pass


def latest_after_delay(df: DataFrame, key: str, version: str | Sequence[str], delay_ms: int = 2000) -> DataFrame:
    """One row per key and burst of versions; version columns must not be null."""
    version = [version] if isinstance(version, str) else version
    return by_bucket(df, [key], LatestAfterDelay(version, delay_ms), df.schema)


class Toggle(_Ordered):
    """Passes the 1st, 3rd, 5th … row of a key."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "odd boolean")

    def handleInputRows(self, key, rows, timerValues):
        odd = self.seen.get()[0] if self.seen.exists() else False
        for row in self.sorted(rows):
            odd = not odd
            if odd:
                yield row
        self.seen.update((odd,))


def toggle(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).transformWithState(Toggle(ts, ties), df.schema, "append", "None")


class TwoInput(_Ordered):
    """Joins details with the one order kept per key; details wait for their order.

    After ``ttl`` past the event time of an order or of a waiting detail the key is
    closed: waiting details come out without an order, and the order is forgotten.
    """

    def __init__(self, key: str, ts: str, side: str, left: Sequence[str], right: Sequence[str],
                 left_schema: T.StructType, right_schema: T.StructType, ttl_ms: int):
        super().__init__(ts, [side])
        self.ts, self.side, self.ttl = ts, side, ttl_ms
        self.left, self.right = list(left), list(right)
        self.out = [key, *left, *right]
        self.left_schema, self.right_schema = left_schema, right_schema

    def init(self, handle) -> None:
        self.handle = handle
        self.order_row = handle.getValueState("order", self.left_schema)
        self.details = handle.getListState("details", self.right_schema)

    def _joined(self, key, order, detail):
        values = (*key, *(order or [None] * len(self.left)), *detail)
        return Row(**dict(zip(self.out, values)))

    def handleInputRows(self, key, rows, timerValues):
        order = _plain(self.order_row.get()) if self.order_row.exists() else None
        waiting = [_plain(d) for d in self.details.get()] if self.details.exists() else []
        held = len(waiting)
        for row in self.sorted(rows):
            close = _millis(row[self.ts]) + self.ttl
            if row[self.side] == 0:
                order = tuple(_plain(row[c]) for c in self.left)
                for detail in waiting:
                    yield self._joined(key, order, detail)
                waiting = []
                self.order_row.update(order)
                self.handle.registerTimer(close)
            else:
                detail = tuple(_plain(row[c]) for c in self.right)
                if order is not None:
                    yield self._joined(key, order, detail)
                else:
                    waiting.append(detail)
                    self.handle.registerTimer(close)
        if waiting:
            self.details.put(waiting)
        elif held:
            self.details.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        order = _plain(self.order_row.get()) if self.order_row.exists() else None
        if self.details.exists():
            for detail in self.details.get():
                yield self._joined(key, order, _plain(detail))
            self.details.clear()
        self.order_row.clear()


def two_input(orders: DataFrame, details: DataFrame, key: str, ts: str, delay: str = "0 seconds",
              ttl_ms: int = 86_400_000) -> DataFrame:
    """Both inputs have ``key`` and the event time ``ts``; other names must differ."""
    left = [c for c in orders.columns if c not in (key, ts)]
    right = [c for c in details.columns if c not in (key, ts)]

    def fields(df: DataFrame, names: list[str]) -> T.StructType:
        return T.StructType([T.StructField(n, df.schema[n].dataType) for n in names])

    left_schema, right_schema = fields(orders, left), fields(details, right)

    def tagged(df: DataFrame, side: int) -> DataFrame:
        kinds = {f.name: f.dataType for f in left_schema.fields + right_schema.fields}
        return df.select(key, ts, F.lit(side).alias("_side"), *[
            F.col(n) if n in df.columns else F.lit(None).cast(kind).alias(n)
            for n, kind in kinds.items()])

    both = tagged(orders, 0).unionByName(tagged(details, 1)).withWatermark(ts, delay)
    out = T.StructType([T.StructField(key, orders.schema[key].dataType)]
                       + left_schema.fields + right_schema.fields)
    return both.groupBy(key).transformWithState(
        TwoInput(key, ts, "_side", left, right, left_schema, right_schema, ttl_ms),
        out, "append", "EventTime")


class TouchedFacts(StatefulProcessor):
    """Gives what a micro-batch needs in order to join its changes anew.

    Of a bucket of parents, rows of parents and rows of children are kept in two lists.  A changed
    child comes out with all its rows and the parent's; a changed parent brings all its children.
    The lists are appended to and read once per micro-batch that touches the bucket.
    """

    def __init__(self, fields: Sequence[str]):
        self.fields = list(fields)

    def init(self, handle) -> None:
        self.parents = handle.getListState("parents", "rows binary")
        self.children = handle.getListState("children", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        new = pa.concat_tables([_rows(row[1]) for row in rows]).combine_chunks()
        is_parent = new["_child"].is_null()
        parents, children = new.filter(is_parent), new.filter(pa.compute.invert(is_parent))
        touched, changed = (pa.compute.unique(t["_key"]) for t in (new, parents))
        pairs = pa.compute.unique(self._pair(children))
        # New rows touch themselves, so what the state held before is all that is read from it.
        yield from self._given(new)
        for (chunk,) in _listed(self.parents):
            table = _rows(chunk)
            yield from self._given(table.filter(pa.compute.is_in(table["_key"], touched)))
        for (chunk,) in _listed(self.children):
            table = _rows(chunk)
            mine = pa.compute.is_in(table["_key"], changed)
            yield from self._given(table.filter(pa.compute.or_(mine, pa.compute.is_in(self._pair(table), pairs))))
        for state, added in ((self.parents, parents), (self.children, children)):
            if added.num_rows:
                state.appendValue((_chunk(added),))

    def _pair(self, rows: pa.Table) -> pa.ChunkedArray:
        """Key and child in one; keys have one length, so different pairs stay different."""
        return pa.compute.binary_join_element_wise(rows["_key"], rows["_child"].cast(pa.binary()), b"")

    def _given(self, rows: pa.Table) -> Iterator[Row]:
        if rows.num_rows:
            yield Row(_rows=_chunk(rows.select(self.fields)))

    def close(self) -> None:
        pass


def touched_facts(df: DataFrame, parent: str) -> DataFrame:
    """``df`` has the parent key, ``_child`` (null for rows of the parent itself) and
    further text columns; the result has the same without ``_child``."""
    out = df.drop("_child").schema
    return by_bucket(df, [parent], TouchedFacts(out.fieldNames()), out, mode="None")


class FirstSeen(StatefulProcessor):
    """Marks the first row of a key; a key is forgotten ``ttl_ms`` after it was first seen.

    Chunks pass one by one, only the earliest row of a new key is held back until all of the
    micro-batch have been seen.  The time to live is that of the state store, by the clock and not
    by event time.  A bucket holds 16 bytes of each of its keys, in one chunk per micro-batch.
    """

    def __init__(self, order: Sequence[str], ttl_ms: int, only: bool):
        self.order, self.ttl, self.only = list(order), ttl_ms, only

    def init(self, handle) -> None:
        self.seen = handle.getListState("seen", "keys binary", self.ttl)

    def _given(self, rows: pa.Table, first: int) -> Iterator[Row]:
        if rows.num_rows:
            if not self.only:
                rows = rows.append_column("is_first", pa.array(np.full(rows.num_rows, first)))
            yield Row(_rows=_chunk(rows.drop_columns(["_key"])))

    def handleInputRows(self, key, rows, timerValues):
        held = b"".join(keys for (keys,) in _listed(self.seen))
        known = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_KEY), len(held) // _KEY, [None, pa.py_buffer(held)]).cast(pa.binary())
        best, order = None, [(c, "ascending") for c in self.order]
        for table in _gathered(_rows(row[1]) for row in rows):
            if len(known):
                seen = pa.compute.is_in(table["_key"], known)
                if not self.only:
                    yield from self._given(table.filter(seen), 0)
                table = table.filter(pa.compute.invert(seen))
            if not table.num_rows:
                continue
            # The place tells rows that lose against a row of their key from the rows that stay.
            table = (table if best is None else pa.concat_tables([best, table])).combine_chunks()
            table = table.append_column("_state_place", pa.array(np.arange(table.num_rows)))
            best = _first_rows(table, ["_key"], order)
            if not self.only:
                beaten = np.ones(table.num_rows, bool)
                beaten[best["_state_place"].to_numpy()] = False
                yield from self._given(table.filter(pa.array(beaten)).drop_columns(["_state_place"]), 0)
            best = best.drop_columns(["_state_place"])
        if best is not None:
            self.seen.appendValue((b"".join(best["_key"].to_pylist()),))
            for i in range(0, best.num_rows, _MOST_ROWS):
                yield from self._given(best.slice(i, _MOST_ROWS), 1)

    def close(self) -> None:
        pass


def first_seen(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = (),
               ttl_ms: int = 86_400_000, only: bool = False) -> DataFrame:
    """Adds ``is_first``, 1 for the first row of a key (in a micro-batch, the earliest by ``ts`` and
    ``ties``, which must not be null), or with ``only`` gives just these rows.

    The result carries no watermark; set one on it to window it in the same query.
    """
    out = df.schema if only else _with(df.schema, is_first=T.LongType())
    return by_bucket(df, keys, FirstSeen([ts, *ties], ttl_ms, only), out)


class PairJoin(StatefulProcessor):
    """Joins the two sides of each key of a bucket in whatever order they come.

    A new left row is joined with the right rows that the state holds, and then added to a list;
    at the end of the micro-batch its new right rows are joined with the whole list.  Rows live
    ``ttl_ms`` each; the lists are appended to and read, never rewritten.  The right side, of which
    a key has few rows, is read once per micro-batch, the left one only for new right rows.  As an
    outer join a left row comes out alone if it has no partner by the end of its micro-batch, and
    again for each partner that comes later.
    """

    def __init__(self, left: Sequence[str], right: Sequence[str], ttl_ms: int, outer: bool):
        self.left, self.right, self.ttl, self.outer = list(left), list(right), ttl_ms, outer

    def init(self, handle) -> None:
        self.lefts = handle.getListState("lefts", "batch bigint, rows binary", self.ttl)
        self.rights = handle.getListState("rights", "rows binary", self.ttl)

    def _joined(self, lefts: pa.Table, rights: pa.Table) -> Iterator[Row]:
        """Left rows with the right rows of their key."""
        ours, theirs = _pairs(lefts["_key"], rights["_key"])
        for i in range(0, len(ours), _MOST_ROWS):
            out, others = lefts.take(ours.slice(i, _MOST_ROWS)).select(self.left), rights.take(theirs.slice(i, _MOST_ROWS))
            for name in self.right:
                out = out.append_column(name, others[name])
            yield self._out(out, 1)

    def _alone(self, lefts: pa.Table, known: pa.Table, fresh: pa.Table) -> Iterator[Row]:
        """Left rows without a right row of their key."""
        for rights in (known, fresh):
            lefts = lefts.filter(pa.compute.invert(pa.compute.is_in(lefts["_key"], rights["_key"])))
        if lefts.num_rows:
            out = lefts.select(self.left)
            for name in self.right:
                out = out.append_column(name, pa.nulls(len(out), fresh[name].type))
            yield self._out(out, 0)

    def _out(self, rows: pa.Table, matched: int) -> Row:
        return Row(_rows=_chunk(rows.append_column("matched", pa.array(np.full(rows.num_rows, matched)))))

    def handleInputRows(self, key, rows, timerValues):
        batch, known, new, alone = timerValues.getCurrentProcessingTimeInMs(), None, [], False
        for table in _gathered(_rows(row[1]) for row in rows):
            if known is None:
                empty = table.slice(0, 0).select([*self.right, "_key"])
                known = pa.concat_tables([empty, *[_rows(chunk) for (chunk,) in _listed(self.rights)]])
            lefts = table.filter(table["_left"]).select([*self.left, "_key"])
            new.append(table.filter(pa.compute.invert(table["_left"])).select([*self.right, "_key"]))
            if lefts.num_rows:
                yield from self._joined(lefts, known)
                self.lefts.appendValue((batch, _chunk(lefts)))
                alone = True
        fresh = pa.concat_tables(new)
        if fresh.num_rows:
            self.rights.appendValue((_chunk(fresh),))
        if fresh.num_rows or self.outer and alone:
            for at, chunk in _listed(self.lefts):
                if fresh.num_rows or at == batch:
                    lefts = _rows(chunk)
                    yield from self._joined(lefts, fresh)
                    if self.outer and at == batch:
                        yield from self._alone(lefts, known, fresh)

    def close(self) -> None:
        pass


def pair_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, ttl_ms: int = 86_400_000,
              how: str = "inner", salts: int = 4) -> DataFrame:
    """Join of two streams without a time range between them, in bounded state.

    The result has the columns of both, whose names must differ, and ``matched``: 0 for a left row
    that came out alone.  Left rows of one key are dealt to ``salts`` parts by a hash and right
    rows go to each part, so a key with very many left rows is several tasks'.
    """
    if how not in ("inner", "left"):
        raise ValueError("an inner or a left join")

    def tagged(df: DataFrame, key: str, other: DataFrame, is_left: bool) -> DataFrame:
        parts = F.sequence(F.lit(0), F.lit(salts - 1))
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int") if is_left else F.explode(parts)
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
        kept = df.where(F.col(key).isNotNull() | F.lit(is_left and how == "left"))
        sides = [*df.columns, *none] if is_left else [*none, *df.columns]
        return kept.select(*sides, F.col(key).alias("_on"), salt.alias("_salt"), F.lit(is_left).alias("_left"))

    def nullable(schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    lefts, rights = nullable(left.schema), nullable(right.schema)
    both = tagged(left, left_key, right, True).unionByName(tagged(right, right_key, left, False))
    out = T.StructType([*lefts.fields, *rights.fields, T.StructField("matched", T.LongType())])
    return by_bucket(both, ["_on"], PairJoin(left.columns, right.columns, ttl_ms, how == "left"), out, ["_salt"], salts)


BITS = 32_768


class SeenBits(_Ordered):
    """A part of a Bloom filter: passes rows whose key was not seen before, as far as its bits tell."""

    def __init__(self, ts: str, ties: Sequence[str], hashes: int):
        super().__init__(ts, ties)
        self.hashes = hashes

    def init(self, handle) -> None:
        self.bits = handle.getValueState("bits", "bits binary")

    def handleInputRows(self, key, rows, timerValues):
        bits = bytearray(self.bits.get()[0]) if self.bits.exists() else bytearray(BITS // 8)
        changed = False
        for row in self.sorted(rows):
            places = [(row["_h1"] + i * row["_h2"]) % BITS for i in range(self.hashes)]
            if all(bits[p >> 3] >> (p & 7) & 1 for p in places):
                continue
            changed = True
            for p in places:
                bits[p >> 3] |= 1 << (p & 7)
            yield row
        if changed:
            self.bits.update((bytes(bits),))


def filter_size(expected: int, error: float) -> tuple[int, int]:
    """Parts of :data:`BITS` bits, and hashes, of a Bloom filter for so many keys."""
    bits = -expected * math.log(error) / math.log(2) ** 2
    return max(1, math.ceil(bits / BITS)), max(1, round(bits / expected * math.log(2)))


def unseen(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = (), expected: int = 1_000_000,
           error: float = 0.01) -> DataFrame:
    """Rows whose key has not come before, by a Bloom filter in state.

    State has a fixed size, whatever the number of keys: up to ``expected`` of them, about a share
    ``error`` of the new keys is taken for seen and left out, beyond that more; a key that was seen
    never passes.  The filter is dealt into parts, each with all the bits of its keys.
    """
    parts, hashes = filter_size(expected, error)
    hashed = df.withColumns({"_part": F.pmod(F.xxhash64(*keys), F.lit(parts)),
                             "_h1": F.xxhash64(F.lit(1), *keys), "_h2": F.xxhash64(F.lit(2), *keys)})
    return hashed.groupBy("_part").transformWithState(
        SeenBits(ts, ties, hashes), hashed.schema, "append", "None").drop("_part", "_h1", "_h2")
