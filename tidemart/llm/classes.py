"""Language-model scoring with word classes found by exchange.

Tokens are lower-case words and one end per text.  Words that occur at least ``frequent`` times in
the training texts, a fixed count whatever their size, are put into ``classes`` classes by
exchange: in each round half of them, by a hash, move to the class that raises the likelihood of
the class bigrams most, given the others, in parallel over the words; the most likely classes of
all rounds are kept.  All other words, known or not, are in one of ``SPELLED`` classes by their
last character, and the end is a class of its own, which also stands before a text.

A token's probability is that of its class after the class before, times that of the word in its
class.  Transitions are counted over all training texts and drawn towards the frequency of the
class by ``KAPPA`` pseudo-counts; words have ``ADD`` pseudo-counts, as has one unknown word in
each spelled class, so that probabilities add up to one.

All counts cover every training document.  Words, their numbers and classes are tables joined by
word.  Texts go in blocks of about ``BLOCK`` bytes; the distinct words of a block are joined with
the table of counts and come back to it, once, and the texts are kept as numbers from then on.
Pairs of numbers are added up in parts of about ``PART`` tokens, by their first word and by their
second; a word that is too frequent for a part has several, by its partner, any other the same one
for both sides.  Each round sends the parts the classes of the numbers in them and gets back the
counts of classes around each word; classes are looked up in slices of ``SLICE`` numbers, each with a
copy for about ``TOGETHER`` parts, and only those asked for are sent.  Only the square of classes goes to tasks and to the
driver.  What a task in Python holds at a time is bounded: the words of about two blocks, the pairs of
a part, the classes around ``CHUNK`` words.

Defined results: null and empty texts hold one token, the end; a null id counts as the text
"null"; equal rows are scored one by one; without training tokens every token has the same
probability; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.llm.common import numbered
from tidemart.session import stored

FREQUENT = 10
CLASSES = 64
SPELLED = 16
ROUNDS = 4
ADD = 0.1
KAPPA = 50.0
ROWS = 1_000
CHUNK = 64
BLOCK = 8 << 20
PART = 1 << 19
SLICE = 1 << 16
TOGETHER = 128
MIX = np.uint64(0x9E3779B97F4A7C15)
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS),
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m"}
END = b""
FIRST = SPELLED + 1


def held_out(doc_id: Column) -> Column:
    """One document in ten is not learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 10 == 0


def spelled(word: bytes) -> int:
    """The class of a word that is not frequent: by its last character."""
    if word and word[-1] < 128:
        return word[-1] % SPELLED
    return sum(word[-4:].decode(errors="ignore")[-1:].encode()) % SPELLED


def spelled_all(words: pa.Array) -> np.ndarray:
    """``spelled`` of words that are not empty."""
    if not len(words):
        return np.empty(0, dtype=np.int32)
    _, offsets, letters = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset + 1:words.offset + len(words) + 1]
    last = np.frombuffer(letters, dtype=np.uint8)[ends - 1]
    kinds, wide = (last % SPELLED).astype(np.int32), np.flatnonzero(last >= 128)
    kinds[wide] = [spelled(w) for w in words.take(pa.array(wide)).to_pylist()]
    return kinds


def tokens_of(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The lower-case words of all texts in order, and how many each has; null has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, of = lists.flatten(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    held = pc.greater(pc.binary_length(found), 0)  # white space at either end leaves an empty one
    return found.filter(held).cast(pa.binary()), np.bincount(of[held.to_numpy(zero_copy_only=False)], minlength=len(lists))


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, spelled, n`` over texts in the column ``text``; each task adds up before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts, names = [], 0, 0, ["word", "spelled", "n"]

        def flush() -> pa.RecordBatch:
            words, n = pc.value_counts(pa.chunked_array(held, pa.binary())).flatten()
            held.clear()
            return pa.record_batch([words, pa.array(spelled_all(words)), n], names=names)
        for batch in batches:
            held.append(tokens_of(batch.column(0))[0])
            size, texts = size + held[-1].nbytes, texts + batch.num_rows
            if size >= 2 * BLOCK:
                yield flush()
                size = 0
        if held:
            yield flush()
        if texts:
            yield pa.record_batch([pa.array([END], pa.binary()), pa.array([0], pa.int32()), pa.array([texts], pa.int64())], names=names)
    return (rows.select("text").mapInArrow(count, "word binary, spelled int, n long")
            .groupBy("word", "spelled").agg(F.sum("n").alias("n")))


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, as every round writes its results, Python
    gets ``ROWS`` rows at a time, and joins with small partitions need no sort."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of ``rid, text`` and more, with the block of each row: the ``rid`` of its first row."""
    block, held = None, BLOCK
    for batch in batches:
        sizes, blocks = pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist(), []
        for rid, size in zip(batch["rid"].to_pylist(), sizes):
            if held >= BLOCK:
                block, held = rid, 0
            held += size + 1
            blocks.append(block)
        yield batch, blocks


def in_blocks(rows: DataFrame) -> DataFrame:
    """Add ``block`` to rows of ``rid, doc_id, held_out, text``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, blocks in blocks_of(batches):
            yield pa.record_batch([pa.array(blocks, pa.int64()), *batch.columns], names=["block", *batch.schema.names])
    return rows.select("rid", "doc_id", "held_out", "text").mapInArrow(
        deal, "block long, rid long, doc_id long, held_out boolean, text string")


def words_of_blocks(rows: DataFrame) -> DataFrame:
    """``block, word``: the distinct words of each block of rows of ``rid, text``."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def flush() -> pa.RecordBatch:
            found = pc.unique(pa.chunked_array(held, pa.binary()))
            held.clear()
            return pa.record_batch([pa.array(np.full(len(found), block, dtype=np.int64)), found], names=["block", "word"])
        for batch, blocks in blocks_of(batches):
            starts = [i for i, at in enumerate(blocks) if i == 0 or at != blocks[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(blocks)]):
                if blocks[a] != block and held:
                    yield flush()
                block = blocks[a]
                held.append(tokens_of(batch["text"].slice(a, b - a))[0])
        if held:
            yield flush()
    return rows.select("rid", "text").mapInArrow(ask, "block long, word binary")


def vocabulary(rows: DataFrame, frequent: int = FREQUENT) -> dict:
    """The ``counts`` of all words of ``text``, and ``words``: ``word, number, n`` of the frequent
    ones, numbered without gaps by falling count from ``FIRST`` on."""
    counts = stored(word_counts(rows), "classes-counts")
    n, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.length("word") == 0).select("n").first()
    counts = counts.where(F.length("word") > 0)
    often = F.col("n") >= frequent
    ranked = stored(counts.where(often).orderBy(F.col("n").desc(), "word").select(
        "word", "n", F.monotonically_increasing_id().alias("place")), "classes-ranked")
    of = F.shiftright("place", 33)  # the partition, whose rows are numbered from the sizes of those before
    sizes = ranked.groupBy(of.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    words = ranked.withColumn("part", of).join(sizes.select("part", before.alias("before")), "part").select(
        "word", (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + FIRST).alias("number"), "n")
    return {"words": stored(words, "classes-words"), "rare": counts.where(~often), "tokens": n, "types": types,
            "ends": ends.n if ends else 0}


def encoded(rows: DataFrame, known: dict) -> DataFrame:
    """``block, doc_id, held_out, n_tokens, n_known, log_sum, ids`` of each text.

    ``ids`` are 32-bit numbers of its words: a spelled class or the number of a frequent word;
    ``log_sum`` adds up the logarithms of the counts of its tokens.
    """
    ends = known["ends"]

    def meet(texts: pa.Table, told: pa.Table) -> pa.Table:
        words, lengths = tokens_of(texts["text"])
        at = pc.fill_null(pc.index_in(words, value_set=told["word"].combine_chunks()), -1).to_numpy()
        new, of = at < 0, np.repeat(np.arange(len(lengths)), lengths)
        ids = np.append(told["number"].to_numpy(), np.int32(0))[at]
        ids[new] = spelled_all(words.filter(pa.array(new)))
        logs = np.log10(np.append(told["n"].to_numpy(), 0) + ADD)  # the last is of a new word
        log_sum = np.bincount(of, weights=logs[at], minlength=len(lengths)) + np.log10(ends + ADD)
        n_known = np.bincount(of[~new], minlength=len(lengths)) + (ends > 0)
        cuts = np.append(0, np.cumsum(lengths * 4)).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype(np.int32))])
        return pa.table({"block": texts["block"], "doc_id": texts["doc_id"], "held_out": texts["held_out"],
                         "n_tokens": pa.array(lengths + 1), "n_known": pa.array(n_known), "log_sum": pa.array(log_sum), "ids": packed})
    counted = known["words"].unionByName(known["rare"].select("word", F.col("spelled").cast("long").alias("number"), "n"))
    told = words_of_blocks(rows).join(counted.withColumnRenamed("word", "known_word"), F.col("word") == F.col("known_word"))
    told = told.select("block", "word", F.col("number").cast("int"), "n")
    return stored(in_blocks(rows).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        meet, "block long, doc_id long, held_out boolean, n_tokens long, n_known long, log_sum double, ids binary"),
        "classes-encoded")


PAIRS = "side int, part long, word binary, other binary, n binary"


def added(word: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, in order, with its sum."""
    if not len(word):
        return word, other, n
    keys = word.astype(np.int64) << 32 | other.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[first] >> 32).astype(np.int32), (keys[first] & 0xFFFFFFFF).astype(np.int32), np.add.reduceat(n[order], first)


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair of neighbours once, in order, with its count."""
    keys = ids[:-1].astype(np.int64)
    keys <<= 32
    keys |= ids[1:]
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n


def dealt(side: int, tokens: int, parts: int, word: np.ndarray, other: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``PAIRS``, one for each part that the pairs go to.

    The word of rank r occurs at most once in r tokens, which bounds the parts it needs.
    """
    rank = np.maximum(word.astype(np.int64) - FIRST + 1, 1)
    salts = (1 + tokens // rank // PART).astype(np.uint64)
    salt = (other.astype(np.uint64) * MIX >> np.uint64(33)) % salts
    part = ((word.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + salt * MIX) >> np.uint64(24)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [x[order] for x in (word, other, n)]
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, dtype=np.int64)
    if len(starts):
        cuts = [*starts.tolist(), len(part)]
        packed = [pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in columns]
        yield pa.record_batch([pa.array(np.full(len(starts), side), pa.int32()), pa.array(part[starts].astype(np.int64)), *packed],
                              names=["side", "part", "word", "other", "n"])


def unpacked(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype=kind)
                 for name, kind in (("word", np.int32), ("other", np.int32), ("n", np.int64)))


def put_together(rows: DataFrame, name: str) -> DataFrame:
    """One row for each part, its pairs added up."""
    def merge(part: pa.Table) -> pa.Table:
        packed = [pa.array([x.tobytes()], pa.binary()) for x in added(*unpacked(part))]
        return pa.table([part["side"].slice(0, 1), part["part"].slice(0, 1), *packed], names=part.column_names)
    return stored(rows.groupBy("side", "part").applyInArrow(merge, PAIRS), name)


def pair_parts(texts: DataFrame, tokens: int) -> DataFrame:
    """Rows of ``PAIRS``, on side 1 several for a part: how often one number comes after another.

    ``word`` is the first of the two on side 0 and the second on side 1; ``SPELLED`` is the end,
    which also stands before a text.
    """
    parts = tokens // PART + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([*held, np.array([SPELLED], dtype=np.int32)])
            held.clear()
            yield from dealt(0, tokens, parts, *counted(ids))
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                held += [np.array([SPELLED], dtype=np.int32), np.frombuffer(ids, dtype=np.int32)]
                size += len(ids) // 4 + 1
                if size >= 4 * PART:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                word, other, n = unpacked(batch.slice(i, 1))
                yield from dealt(1, tokens, parts, other, word, n)
    behind = put_together(texts.select("ids").mapInArrow(count, PAIRS), "classes-behind")
    return behind.unionByName(behind.mapInArrow(turn, PAIRS))


PARTS = "part long, numbers binary, " + ", ".join(f"word{side} binary, other{side} binary, n{side} binary" for side in (0, 1))


def by_place(pairs: DataFrame) -> DataFrame:
    """One row for each part: the ``numbers`` in it, in order, and the pairs of both sides, added up, by
    the places of their numbers there."""
    def place(rows: pa.Table) -> pa.Table:
        both = [added(*unpacked(rows.filter(pc.equal(rows["side"], side)))) for side in (0, 1)]
        numbers = np.unique(np.concatenate([x for word, other, _ in both for x in (word, other)]))
        columns = [numbers]
        for word, other, n in both:
            columns += [np.searchsorted(numbers, word).astype(np.int32), np.searchsorted(numbers, other).astype(np.int32), n]
        return pa.table([rows["part"].slice(0, 1), *[pa.array([x.tobytes()], pa.binary()) for x in columns]],
                        names=["part", "numbers", *[f"{name}{side}" for side in (0, 1) for name in ("word", "other", "n")]])
    return stored(pairs.groupBy("part").applyInArrow(place, PARTS), "classes-parts")


def asked_by(rows: DataFrame) -> DataFrame:
    """``key, slice, places``: where in which slices the 32-bit numbers of ``key, numbers`` are; rows of
    a key that follow each other ask together."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> pa.RecordBatch:
            numbers = np.unique(np.concatenate(held)).astype(np.int64)
            held.clear()
            starts = np.flatnonzero(np.diff(numbers // SLICE, prepend=-1))
            places = np.split((numbers % SLICE).astype(np.uint16), starts[1:]) if len(starts) else []
            return pa.record_batch([pa.array(np.full(len(starts), key, dtype=np.int64)), pa.array(numbers[starts] // SLICE),
                                    pa.array([x.tobytes() for x in places], pa.binary())], names=["key", "slice", "places"])
        for batch in batches:
            for at, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != key and held:
                    yield flush()
                key = at
                held.append(np.frombuffer(numbers, dtype=np.int32))
        if held:
            yield flush()
    return rows.mapInArrow(ask, "key long, slice long, places binary")


def told_to(asked: DataFrame, class_of: DataFrame, tokens: int) -> DataFrame:
    """``asked`` and ``classes``, 16 bits for each place."""
    salts = 1 + tokens // PART // TOGETHER
    fixed = class_of.sparkSession.range(FIRST).select(F.col("id").alias("number"), F.col("id").cast("int").alias("class"))
    in_order = F.sort_array(F.collect_list(F.struct("number", "class")))
    slices = (fixed.unionByName(class_of).groupBy(F.floor(F.col("number") / SLICE).cast("long").alias("slice"))
              .agg(F.transform(in_order, lambda x: x["class"].cast("short")).alias("classes"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))

    def answer(asks: pa.Table, told: pa.Table) -> pa.Table:
        classes = told["classes"].combine_chunks().flatten().to_numpy()
        found = [classes[np.frombuffer(x, dtype=np.uint16)].tobytes() for x in asks["places"].to_pylist()]
        return asks.drop_columns(["salt"]).append_column("classes", pa.array(found, pa.binary()))
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
    return salted.groupBy("slice", "salt").cogroup(slices.groupBy("slice", "salt")).applyInArrow(
        answer, "key long, slice long, places binary, classes binary")


def classes_told(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that a group asked for, in order, and their classes."""
    numbers = [np.frombuffer(x, dtype=np.uint16).astype(np.int64) + at * SLICE for at, x in zip(told["slice"].to_pylist(), told["places"].to_pylist())]
    classes = np.frombuffer(b"".join(told["classes"].to_pylist()), dtype=np.int16)
    numbers, first = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *numbers]), return_index=True)
    return numbers, classes[first].astype(np.int64)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(square: np.ndarray, now: np.ndarray, starts: np.ndarray, at: np.ndarray, n: np.ndarray, first: int,
                 logs: np.ndarray) -> np.ndarray:
    """The class from ``first`` on where each word adds most to the likelihood of the class bigrams.

    From ``starts`` of a word to the next, ``at`` and ``n`` count the classes around it: those behind
    it, its own repetitions left out, from 0 on, those ahead from the number of classes on, and its
    repetitions from twice that on; ``logs`` is ``_f`` of the square.
    """
    size, each = len(square), np.arange(len(now))
    word = np.repeat(each, np.diff(starts))
    around = np.bincount(word * 3 * size + at, weights=n, minlength=len(now) * 3 * size).reshape(-1, 3, size)
    after, before, self_n = around[:, 0], around[:, 1], around[:, 2].sum(axis=1)
    # What is left of the row and of the column of a word's class without it.
    row, column = np.maximum(square[now] - after, 0), np.maximum(square.T[now] - before, 0)
    corner = np.maximum(square[now, now] - after[each, now] - before[each, now] - self_n, 0)
    row[each, now] = column[each, now] = corner
    gain = np.zeros((len(now), size))
    for counts, plane, log_plane, cell, line in ((after, square.T, logs.T, row, column), (before, square, logs, column, row)):
        w, k = np.nonzero(counts)  # nothing changes elsewhere
        if not len(w):
            continue
        rest, log_rest, entry, own = plane[k], log_plane[k], np.arange(len(w)), k == now[w]
        rest[entry, now[w]], log_rest[entry, now[w]] = cell[w, k], _f(cell[w, k])
        rest[own], log_rest[own] = line[w[own]], _f(line[w[own]])
        rest += counts[w, k, None]
        cuts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        gain[w[cuts]] += np.add.reduceat(_f(rest) - log_rest, cuts, axis=0)
    own = np.tile(square.diagonal(), (len(now), 1))
    own[each, now] = corner
    log_own = _f(own)
    gain += _f(own + after + before + self_n[:, None]) - _f(own + after) - _f(own + before) + log_own
    for total, more in ((square.sum(axis=1), after.sum(axis=1) + self_n), (square.sum(axis=0), before.sum(axis=1) + self_n)):
        side = np.tile(total, (len(now), 1))
        side[each, now] = np.maximum(side[each, now] - more, 0)
        gain -= _f(side + more[:, None]) - _f(side)
    gain[:, :first] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[each, best] > gain[each, now] + 1e-6, best, now)


def best_class(square: np.ndarray, now: int, after: np.ndarray, before: np.ndarray, self_n: float, first: int) -> int:
    """``best_classes`` of one word."""
    n = np.concatenate([after, before, [self_n]])
    return int(best_classes(square, np.array([now]), np.array([0, len(n)]), np.arange(len(n)), n, first, _f(square))[0])


def half(word: np.ndarray, turn: int) -> np.ndarray:
    """Half of the frequent words, the other half in the next turn."""
    return (word >= FIRST) & ((word.astype(np.uint64) * MIX >> np.uint64(40)) % np.uint64(2) == turn % 2)


CONTEXTS = ("word long, sides array<long>, others array<long>, ns array<long>, "
            "numbers binary, now binary, lengths binary, at binary, n binary")


def contexts(parts: DataFrame, asked: DataFrame, class_of: DataFrame, size: int, turn: int | None, tokens: int,
             spread: int) -> DataFrame:
    """How often which classes are behind (side 0) and ahead (1) of the words that move in a turn;
    side 2 is the word itself.

    Words from ``spread`` on are in one part: a row has all words of a part, packed, ``lengths`` of
    them in ``at`` and ``n`` as ``best_classes`` takes them, and ``now``, their classes.  The others
    have rows of ``word, sides, others, ns``, to be added up.  The square of classes, ``sides`` before
    ``others``, is in rows without a word."""
    def count(rows: pa.Table, told: pa.Table) -> pa.Table:
        (numbers, classes), keys, ns, square = classes_told(told), [], [], np.zeros(size * size)
        moves = half(numbers, turn) if turn is not None else None
        for side in (0, 1):
            word, other, n = (np.frombuffer(rows[f"{name}{side}"][0].as_py(), dtype=kind)
                              for name, kind in (("word", np.int32), ("other", np.int32), ("n", np.int64)))
            to = classes[other]
            if side == 0:
                square += np.bincount(classes[word] * size + to, weights=n, minlength=size * size)
            if turn is not None:
                moving = moves[word] & ((word != other) | (side == 0))
                word, other, to = (x[moving].astype(np.int64) for x in (word, other, to))
                keys.append((word * 3 + np.where(word == other, 2, side)) * size + to)
                ns.append(n[moving])
        keys, back = np.unique(np.concatenate([*keys, np.empty(0, dtype=np.int64)]), return_inverse=True)
        sums = np.bincount(back, weights=np.concatenate([*ns, []]), minlength=len(keys)).astype(np.int64)
        place, lengths = np.unique(keys // size // 3, return_counts=True)
        word = numbers[place]
        wide = int(np.searchsorted(word, spread))
        cut = int(lengths[:wide].sum())
        at = np.flatnonzero(square)
        offsets = pa.array(np.cumsum([0, len(at), *lengths[:wide]]), pa.int32())
        columns = zip((at // size, at % size, square[at].astype(np.int64)), (keys[:cut] // size % 3, keys[:cut] % size, sums[:cut]))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), pa.int64())) for x in columns]
        packed = (word[wide:], classes[place[wide:]].astype(np.int32), lengths[wide:].astype(np.int32),
                  (keys[cut:] % (3 * size)).astype(np.int32), sums[cut:])
        return pa.table([pa.array([None, *word[:wide].tolist()], pa.int64()), *lists,
                         *[pa.array([x.tobytes(), *[None] * wide], pa.binary()) for x in packed]],
                        names=["word", "sides", "others", "ns", "numbers", "now", "lengths", "at", "n"])
    told = told_to(asked, class_of, tokens)
    return parts.groupBy("part").cogroup(told.groupBy("key")).applyInArrow(count, CONTEXTS)


def summed(around: DataFrame, *key: str) -> DataFrame:
    """``key, side, other, n``: contexts that several parts hold, added up."""
    each = F.explode(F.arrays_zip("sides", "others", "ns")).alias("x")
    return (around.select(*key, each).groupBy(*key, F.col("x.sides").alias("side"), F.col("x.others").alias("other"))
            .agg(F.sum("x.ns").alias("n")))


def moves(around: DataFrame, square: np.ndarray, class_of: DataFrame) -> DataFrame:
    """``word, best`` of the words whose contexts are given."""
    sent = around.sparkSession.sparkContext.broadcast(square)

    def moved(number: np.ndarray, now: np.ndarray, lengths: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        square, starts, best = sent.value, np.append(0, np.cumsum(lengths)), []
        logs = _f(square)
        for i in range(0, len(number), CHUNK):
            cuts = starts[i:i + CHUNK + 1]
            best.append(best_classes(square, now[i:i + CHUNK].astype(np.int64), cuts, at[cuts[0]:cuts[-1]], n[cuts[0]:cuts[-1]], FIRST, logs))
        return pa.record_batch([pa.array(number), pa.array(np.concatenate(best).astype(np.int32))], names=["word", "best"])

    def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.int64, np.int32, np.int32, np.int32, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                packed = [np.frombuffer(c[i].as_py(), dtype=kind) for c, kind in zip(batch.columns, kinds)]
                if len(packed[0]):
                    yield moved(*packed)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(k).flatten().to_numpy() for k in (2, 3, 4)]
            if batch.num_rows:
                yield moved(batch.column(0).to_numpy(), batch.column(1).to_numpy(), pc.list_value_length(batch.column(2)).to_numpy(),
                            lists[0] * len(sent.value) + lists[1], lists[2])
    wide = summed(around.where("word IS NOT NULL"), "word").groupBy("word").agg(
        F.collect_list("side").alias("sides"), F.collect_list("other").alias("others"), F.collect_list("n").alias("ns"))
    placed = wide.join(class_of, wide["word"] == class_of["number"]).select("word", "class", "sides", "others", "ns")
    packed = around.where("word IS NULL").select("numbers", "now", "lengths", "at", "n")
    return packed.mapInArrow(of_parts, "word long, best int").unionByName(placed.mapInArrow(of_words, "word long, best int"))


def exchange(pairs: DataFrame, words: DataFrame, tokens: int, classes: int = CLASSES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[float]]:
    """``number, class`` of the frequent words, the counts of class bigrams, and the likelihood
    (natural logarithm a token) of the class bigrams before each round and after the last.

    Frequent words start in turn; the first ``FIRST`` classes are fixed.  Words that move at one
    time may get in each other's way, so of all rounds the classes that are most likely are
    returned.  What reaches the driver is the square of classes.
    """
    size, spread = FIRST + classes, tokens // PART + FIRST
    parts = by_place(pairs)
    asked = stored(asked_by(parts.select(F.col("part").alias("key"), "numbers")), "classes-asked")
    class_of = stored(words.select("number", (F.col("number") % classes + FIRST).cast("int").alias("class")), "classes-of")
    likelihoods, most_likely = [], None
    for turn in range(rounds + 1):
        last = turn == rounds
        around = stored(contexts(parts, asked, class_of, size, None if last else turn, tokens, spread), "classes-around")
        square = np.zeros((size, size))
        for r in summed(around.where("word IS NULL")).collect():
            square[r.side, r.other] = r.n
        gain = _f(square).sum() - _f(square.sum(axis=0)).sum() - _f(square.sum(axis=1)).sum() + _f(square.sum())
        likelihoods.append(float(gain / max(square.sum(), 1)))
        if likelihoods[-1] == max(likelihoods):
            most_likely = class_of, square
        if last:
            return *most_likely, likelihoods
        moved = moves(around, square, class_of)
        class_of = stored(class_of.join(moved, class_of["number"] == moved["word"], "left")
                          .select("number", F.coalesce("best", "class").alias("class")), "classes-of")


class Model(dict):
    """The model; ``sent`` is all of it on the driver, to look at a small one."""

    def __missing__(self, key: str) -> dict:
        if key != "sent":
            raise KeyError(key)
        rows = self["known"].where(F.col("class") >= FIRST).orderBy(F.col("n").desc(), "word").collect()
        return {"frequent": {bytes(r.word): FIRST + i for i, r in enumerate(rows)}, "ratio": self["ratio"],
                "class_of": np.array([*range(FIRST), *[r["class"] for r in rows]]),
                "log_counts": np.log10(np.array([*[1 - ADD] * SPELLED, self["ends"], *[r.n for r in rows]]) + ADD)}


def fit(known: dict, texts: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """The model of encoded training texts: ``known``, a table of all words with count and class,
    the ``counts`` of those that are not frequent, and what is bounded."""
    n, types, words, rare = known["tokens"], known["types"], known["words"], known["rare"]
    rest = {r.spelled: r["count"] for r in rare.groupBy("spelled").count().collect()}
    class_of, square, likelihoods = exchange(pair_parts(texts, n), words, n, classes, rounds)
    classed = words.join(class_of, "number").select("word", "class", "n")
    size = np.zeros(len(square))
    for r in class_of.groupBy("class").count().collect():
        size[r["class"]] = r["count"]
    size[:SPELLED] = [rest.get(k, 0) + 1 for k in range(SPELLED)]  # one of them is unknown
    size[SPELLED] = 1
    counted = square.sum(axis=0)
    whole = n + ADD * size.sum()
    p = (counted + ADD * size) / whole
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log10((square + KAPPA * p) / (square.sum(axis=1, keepdims=True) + KAPPA) / p)
    return Model(known=classed.unionByName(rare.select("word", F.col("spelled").alias("class"), "n")), class_of=class_of,
                 counts=rare.select("word", "n"), tokens=n, types=types, whole=whole, ratio=ratio, ends=known["ends"],
                 likelihoods=likelihoods)


def train(rows: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """The model of training ``text``."""
    known = vocabulary(rows, frequent)
    texts = numbered(rows, F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), rows["text"])
    return fit(known, encoded(texts, known), classes, rounds)


def score(texts: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of encoded texts."""
    sent = texts.sparkSession.sparkContext.broadcast(model["ratio"])

    def of_block(rows: pa.Table, told: pa.Table) -> pa.Table:
        lengths = pc.binary_length(rows["ids"]).to_numpy() // 4
        ids = np.frombuffer(b"".join(rows["ids"].to_pylist()), dtype=np.int32)
        kinds = np.full(len(ids) + len(lengths) + 1, SPELLED, dtype=np.int64)  # an end before each text and behind the last
        if len(ids):
            numbers, classes = classes_told(told)
            kinds[np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths) + 1] = classes[np.searchsorted(numbers, ids)]
        starts = np.cumsum(lengths + 1) - lengths - 1
        sums = np.add.reduceat(sent.value[kinds[:-1], kinds[1:]], starts)
        return rows.drop_columns(["block", "ids"]).append_column("log_ratio", pa.array(sums, pa.float64()))
    asked = asked_by(texts.select(F.col("block").alias("key"), F.col("ids").alias("numbers")))
    told = told_to(asked, model["class_of"], model["tokens"])
    docs = texts.groupBy("block").cogroup(told.groupBy("key")).applyInArrow(
        of_block, "doc_id long, held_out boolean, n_tokens long, n_known long, log_sum double, log_ratio double")
    base = float(np.log10(model["tokens"] + ADD * (model["types"] + 1)))
    own = float(np.log10(model["whole"]))
    return docs.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("log_sum") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("log_sum") - F.col("n_tokens") * F.lit(own) + F.col("log_ratio")).alias("score"))


def judge(docs: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Scores, and ``perplexity``, of every document under the model of those not held out."""
    rows = numbered(docs, docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"])
    with swept(docs.sparkSession):
        known = vocabulary(rows.where(~F.col("held_out")), frequent)
        texts = encoded(rows, known)
        model = fit(known, texts.where(~F.col("held_out")), classes, rounds)
    return score(texts, model).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
