"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every node, from the definitions; turns with one number must not differ."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    again = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = turns.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        again[c] = [*first[:h], *own[h:]]
    members = defaultdict(list)
    for c, seq in again.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, below = [], {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below[node] = leaves, own + sum(below[k][1] for k in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(again[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
                    *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **more):
    return sorted((tuple(r) for r in prefixes.conversation_trie(df, **more).collect()), key=repr)


def test_given_conversations(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    assert found(df) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("seed, batches, block", [(1, 1, 4_096), (2, 3, 2)])
def test_branching_conversations(spark, monkeypatch, seed, batches, block):
    """Few texts, so that paths part, end inside others and repeat; blocks of a few turns."""
    monkeypatch.setattr(prefixes, "BLOCK", block)
    monkeypatch.setattr(prefixes, "CHUNK_BITS", 3)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1_000), 120):
        same = rng.random() < 0.2
        for turn in range(rng.choice((1, 2, 3, 5, 9, 17))):
            rows.append((c, turn, rng.choice(("user", None)), "😀 same" if same else rng.choice(("a", "bb", None, ""))))
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA), batches=batches) == plain(rows)


def test_odd_rows(spark):
    rows = [(0, None, "user", "first"), (0, 1, "user", "x" * 20_000), (0, 1, "user", "x" * 20_000), (7, 3, None, None),
            (250, 0, "user", "alone"), (-7, 0, "user", "below"), (None, 0, "user", "no id")]
    df = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], SCHEMA + ", depth long, path string, k1 int")
    assert found(df) == plain(rows)
    assert found(df.where("conv_id IS NULL")) == []


def test_two_fattest(spark):
    rows = [(low, high) for low in range(20) for high in range(low + 1, 40)]
    df = spark.createDataFrame(rows, "low long, high long").withColumn("f", prefixes.two_fattest("low", "high"))
    for r in df.collect():
        assert r.f == max(range(r.low + 1, r.high + 1), key=lambda x: x & -x)


def test_fat_binary_search_finds_the_exit(spark):
    """The exit of every path of a second batch, by hand: the deepest node whose edge it enters."""
    rng = random.Random(4)
    seqs = sorted({tuple(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(80)})
    rows = [(i, d + 1, "user", x) for i, s in enumerate(seqs) for d, x in enumerate(s)]
    placed = prefixes.turns(spark.createDataFrame(rows, SCHEMA))
    every = prefixes.prefixes(placed.withColumnRenamed("place", "depth"))
    lengths = spark.createDataFrame([(i, len(s)) for i, s in enumerate(seqs)], "path long, length long")
    digests = every.withColumnRenamed("conv_id", "path").join(lengths, "path")
    old = lengths.where("path % 2 = 0")
    nodes = prefixes.grown(old, digests)
    explicit = set()
    for i in range(0, len(seqs), 2):
        for d in range(len(seqs[i]) + 1):
            p = seqs[i][:d]
            after = {s[:d + 1] for s in seqs[::2] if s[:d] == p and len(s) > d}
            if p and (d == len(seqs[i]) or len(after) > 1):
                explicit.add(p)
    assert sorted(r.high for r in nodes.where("high > 0").collect()) == sorted(map(len, explicit))
    exits = {r.path: r for r in prefixes.exits(lengths.where("path % 2 = 1"), digests, nodes).collect()}
    for i in range(1, len(seqs), 2):
        s, best = seqs[i], 0
        for e in explicit:
            low = max((d for d in range(1, len(e)) if e[:d] in explicit), default=0)
            if s[:low + 1] == e[:low + 1]:
                best = max(best, len(e) if len(s) > low else 0)
        assert exits[i].high == best
    assert nodes.where(F.col("f") > F.col("high")).count() == 0
