"""SimHash near duplicates through an inverted index on byte positions.

A fingerprint is 64 bits: bit k is set if it is set in over half of the XXH64 (seed 42) of the
text's 4-word shingles.  Two fingerprints that differ in at most 4 bits differ in at most 4 of
their 8 bytes, so they share at least 4 positional bytes.  The index has one posting list for
each value of three byte positions; the 20 triples are chosen such that any 4 positions hold
one of them, so every such pair meets in a list.  In a list the shared positional bytes of a
pair are tallied; pairs that reach 4 are verified by the number of differing bits.

Equal fingerprints are one entry.  A list longer than ``TILE`` is dealt by hash into chunks, and
each pair of chunks is a task of its own, so no list is held whole; inside such a pair of chunks
what a search from one entry reaches by links is tied to that entry, so a dense group of near
copies gives neither all its pairs nor long chains.

Defined results: null and empty texts have fingerprint zero and link like any other; equal rows
get equal fingerprints; a component of which no document has an id has component null; an empty
table gives none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import byte_texts, row_name, runs, text_mark
from tidemart.llm.graph import components
from tidemart.session import stored

SHINGLE = 4
BITS = 4
SHARED = 4
SEED = 42
TILE = 8_192
SMALL = 24
BLOCK = 1 << 16


def triples() -> list[tuple[int, int, int]]:
    """Three of the 8 positions in 20 ways, so that any 4 positions hold one of them.

    The positions stand in a ring of three groups; a triple lies in one group, or has two
    positions of a group and one of the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    kinds = {(g, g, g) for g in range(3)} | {tuple(sorted((g, g, (g + 1) % 3))) for g in range(3)}
    return [t for t in itertools.combinations(range(8), 3) if tuple(sorted(group[i] for i in t)) in kinds]


def fingerprint(text: bytes) -> bytes:
    """The 8 bytes of a text's fingerprint, highest first."""
    from xxhash import xxh64_digest
    words = text.lower().split()
    if not words:
        return bytes(8)
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        digests = b"".join([xxh64_digest(b" ".join(words[i:i + SHINGLE]), SEED)
                            for i in range(at, min(n, at + BLOCK))])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, mark`` (a hash of the text), ``fingerprint`` (16 hex digits) and ``print``, the
    same as a signed number."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t) for t in byte_texts(batch.column(1))]
            yield pa.record_batch({
                "doc_id": batch.column(0), "mark": batch.column(2), "fingerprint": pa.array([p.hex() for p in prints], pa.string()),
                "print": pa.array(np.frombuffer(b"".join(prints), dtype=">i8").astype(np.int64))})
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], text_mark(docs["text"]))
    return rows.mapInArrow(digest, "doc_id long, mark long, fingerprint string, print long")


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 56 - 8 * position).bitwiseAND(F.lit(255))


def _keys(value: Column) -> Column:
    """Posting lists of a fingerprint: the triple's number and its three bytes."""
    return F.array(*[
        (F.lit(n << 24) + _byte(value, a) * F.lit(1 << 16) + _byte(value, b) * F.lit(1 << 8) + _byte(value, c)).cast("int")
        for n, (a, b, c) in enumerate(triples())])


def postings(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """``key, lo, hi, print``: a posting list is one task's work, a long one a pair of chunks."""
    index = prints.select(F.explode(_keys(F.col("print"))).alias("key"), "print")
    long_lists = stored(index.groupBy("key").count().where(F.col("count") > tile)
                        .select(F.col("key").alias("long_key"), F.ceil(F.col("count") / tile).cast("int").alias("chunks")),
                        "simhash-long-lists")
    dealt = index.join(long_lists, index["key"] == long_lists["long_key"], "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int"), F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))
    return dealt.select("key", "chunk", "print", other.alias("other")).select(
        "key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "print")


def _tally(x: np.ndarray) -> np.ndarray:
    """Shared positional bytes of pairs, from the exclusive or of their fingerprints."""
    return (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _near(x: np.ndarray) -> np.ndarray:
    """Which pairs pass the count filter and differ in few enough bits."""
    reach = _tally(x) >= SHARED
    reach[reach] = np.bitwise_count(x[reach]) <= BITS
    return reach


def _forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """Ties from the first entry of each of a long list's components to the others, which it
    reaches by links; each entry is searched from once and compared with those that no search
    has reached."""
    rest, edges = np.arange(len(prints)), []
    while len(rest):
        first, rest = rest[0], rest[1:]
        ahead = [first]
        while ahead and len(rest):
            at = ahead.pop()
            near = _near(prints[rest] ^ prints[at])
            found, rest = rest[near], rest[~near]
            edges += [(first, j) for j in found]
            ahead += found.tolist()
    return edges


def link_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` inside each run of equal key, lo and hi; ties in long runs."""
    for table in runs(batches, ["key", "lo", "hi"]):
        prints = table.column("print").to_numpy().view(np.uint64)
        change = np.zeros(len(prints), dtype=bool)
        for name in ("key", "lo", "hi"):
            column = table.column(name).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(np.concatenate([[True], change[1:]]))
        ends = np.append(starts[1:], len(prints))
        size = ends - starts
        room = np.where(size <= SMALL, size, 0).repeat(size) - (np.arange(len(prints)) - starts.repeat(size))
        left, right = [], []
        for step in range(1, SMALL):
            at = np.flatnonzero(room > step)  # the entry that far on is in the same short list
            if not len(at):
                break
            at = at[_near(prints[at] ^ prints[at + step])]
            left.append(at)
            right.append(at + step)
        for i in np.flatnonzero(size > SMALL):
            edges = np.array(_forest(prints[starts[i]:ends[i]]), dtype=np.int64).reshape(-1, 2) + starts[i]
            left.append(edges[:, 0])
            right.append(edges[:, 1])
        if left:
            a, b = prints[np.concatenate(left)], prints[np.concatenate(right)]
            yield pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def links(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints ``print``, linked directly or by way of others;
    their components are those of all links."""
    lists = postings(prints, tile).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "print")
    return lists.mapInArrow(link_postings, "a long, b long").distinct()


def classed(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """Stored ``doc_id, mark, fingerprint, root``: ``root`` is the same for all documents of a
    component, ``mark`` a hash of the text."""
    rows = stored(fingerprints(docs), "simhash-prints")
    classes = stored(rows.select("print").distinct(), "simhash-classes")
    roots = stored(components(links(classes, tile)), "simhash-roots")
    rooted = rows.join(roots, rows["print"] == roots["node"], "left")
    return stored(rooted.select("doc_id", "mark", "fingerprint", F.coalesce("root", "print").alias("root")),
                  "simhash-classed")


def near_duplicates(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document: the smallest id reachable."""
    rows = classed(docs, tile)
    ids = stored(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash-ids")
    ids = ids.select(F.col("root").alias("id_root"), "component_id")
    return rows.join(ids, rows["root"] == ids["id_root"]).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One document of each component, columns unchanged: the one with the smallest id, and
    of equal ids that with the smallest hash of its text; equal rows stay once."""
    name = row_name(F.col("doc_id"), F.col("mark"))
    kept = (classed(docs, tile).groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
            .select("first.*").select(name.alias("simhash_kept")))
    named = docs.select(F.struct("*").alias("doc"), row_name(docs["doc_id"].cast("long"), text_mark(docs["text"])).alias("name"))
    return named.join(kept, named["name"] == kept["simhash_kept"], "left_semi").dropDuplicates(["name"]).select("doc.*")
