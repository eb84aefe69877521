"""Prefix trie of conversations, kept as a z-fast trie in tables.

A conversation is a sequence of turns, and the first ``d`` of them are a prefix with a digest of
128 bits: the exclusive or of two hashes of every turn with its place.  So the digests of all
prefixes are a running aggregate, and a long conversation is cut into blocks of turns that are
added up apart.  Equal sequences are one path, with how many conversations have it.

The trie has a row for each compacted node: its extent, which is the digest and depth of the
prefix at which paths part or end; the depth of the node above; and its handle, the digest of the
prefix at the two-fattest depth between both, the one that most powers of two divide.  Paths are
put in by batches, a hash of the path says which.  A fat binary search, a join by handle each
round for all paths of the batch, and a look at the edges below find the node where a path leaves
the trie, in as many rounds as the logarithm of the longest path.  Only the edges that are left that way are cut: what parts or
ends on them and on the new rest of the paths becomes nodes, with handles anew.

At the end edges are expanded to a row for each depth.  Sums over a subtree are sums over the paths
through its top: a path owns the nodes of which it is the smallest, which are the last ones on it.

Defined results: turns are ordered by number, null first, and turns with one number by a hash of
role and text; a null role or text is empty; rows without an id are no conversation and are left
out; repeated rows are repeated turns; the remainder of a negative id is not positive; digests
are compared, not texts; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import numbered
from tidemart.session import stored

HEAD = 6
FAMILY = 100
BATCHES = 2
BLOCK = 4_096
CHUNK_BITS = 16
KEY = ["depth", "k1", "k2"]
_COMBINE = {"sum": lambda a, b: a + F.coalesce(b, F.lit(0)), "bit_xor": lambda a, b: a.bitwiseXOR(F.coalesce(b, F.lit(0))),
            "max": F.greatest, "min": F.least}


def running(rows: DataFrame, key: str, block: str, order: list[str], values: dict[str, tuple[str, Column]],
            before: bool = False, backwards: bool = False) -> DataFrame:
    """Add running aggregates of ``values`` (name: aggregate and column) in each key's order.

    Blocks of a key are added up apart, and each then gets the total of those before it (after
    it, backwards), so a long key is no single task's.  ``before`` leaves out the row itself.
    """
    def ordered(w, names):
        return w.orderBy(*[F.col(c).desc() if backwards else F.col(c).asc() for c in names])
    inside = ordered(Window.partitionBy(key, block), order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    ahead = ordered(Window.partitionBy("total_key"), ["total_block"]).rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy(F.col(key).alias("total_key"), F.col(block).alias("total_block"))
              .agg(*[getattr(F, how)(value).alias(f"t_{name}") for name, (how, value) in values.items()]))
    carried = totals.select("total_key", "total_block", *[getattr(F, how)(f"t_{name}").over(ahead).alias(f"c_{name}")
                                                          for name, (how, _) in values.items()])
    local = rows.select("*", *[getattr(F, how)(value).over(inside).alias(f"l_{name}") for name, (how, value) in values.items()])
    both = local.join(carried, (local[key] == carried["total_key"]) & (local[block] == carried["total_block"]))
    return both.select(*rows.columns, *[_COMBINE[how](F.col(f"l_{name}"), F.col(f"c_{name}")).alias(name)
                                        for name, (how, _) in values.items()])


def blocks(depth: str) -> Column:
    return F.floor(F.col(depth) / BLOCK)


def turns(conversations: DataFrame) -> DataFrame:
    """Stored ``conv_id, place, a, b, chars``: turns numbered from 1 on, with two hashes."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    rows = numbered(conversations, conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"),
                    F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"),
                    F.length(text).cast("long").alias("chars")).where("conv_id IS NOT NULL")
    order = ["turn", "a", "b", "rid"]
    spread = stored(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "trie-spread")
    placed = running(spread, "conv_id", "part", order, {"place": ("sum", F.lit(1).cast("long"))})
    return stored(placed.select("conv_id", "place", "a", "b", "chars"), "trie-turns")


def rebuilt(placed: DataFrame, head: int = HEAD, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, a, b, chars`` of rebuilt conversations, and stored ``conv_id, length`` of all.

    The first turns, fewer than ``head`` and drawn by the id, are those of the first conversation
    of the family.
    """
    sizes = stored(placed.groupBy("conv_id").agg(F.max("place").alias("size")), "trie-sizes")
    ids = sizes.select("conv_id", "size", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).alias("h"),
                       (F.col("conv_id") - F.col("conv_id") % family).alias("first"))
    firsts = sizes.select(F.col("conv_id").alias("first_id"), F.col("size").alias("first_size"))
    ids = ids.join(firsts, ids["first"] == firsts["first_id"], "left")
    ids = stored(ids.select("conv_id", "h", "first", F.least("h", F.coalesce("first_size", F.lit(0))).alias("lead"),
                            F.greatest(F.col("size") - F.col("h"), F.lit(0)).alias("rest")), "trie-ids")
    heads = placed.where(F.col("place") < head).withColumnRenamed("conv_id", "head_id")
    shared = (ids.join(heads, (ids["first"] == heads["head_id"]) & (heads["place"] <= ids["h"]))
              .select("conv_id", F.col("place").alias("depth"), "a", "b", "chars"))
    names = ids.select(F.col("conv_id").alias("own_id"), "h", "lead")
    own = (placed.join(names, (placed["conv_id"] == names["own_id"]) & (placed["place"] > names["h"]))
           .select("conv_id", (F.col("lead") + F.col("place") - F.col("h")).alias("depth"), "a", "b", "chars"))
    return shared.unionByName(own), ids.select("conv_id", (F.col("lead") + F.col("rest")).alias("length"))


def prefixes(rows: DataFrame) -> DataFrame:
    """Stored ``conv_id, depth, k1, k2, p, q, chars, upto``: digests, what the last turn adds to
    them, its length and that of all so far."""
    tagged = rows.select("conv_id", "depth", "chars", blocks("depth").alias("block"),
                         F.xxhash64(F.lit(1), "depth", "a", "b").alias("p"), F.xxhash64(F.lit(2), "depth", "b", "a").alias("q"))
    added = running(tagged, "conv_id", "block", ["depth"], {"k1": ("bit_xor", F.col("p")), "k2": ("bit_xor", F.col("q")),
                                                          "upto": ("sum", F.col("chars"))})
    return stored(added.drop("block"), "trie-prefixes")


def ends_of(every: DataFrame, lengths: DataFrame) -> DataFrame:
    """Stored ``conv_id, depth, k1, k2, total``: the whole sequence of every conversation."""
    last = every.select(F.col("conv_id").alias("last_id"), F.col("depth").alias("last"), "k1", "k2", "upto")
    found = lengths.join(last, (lengths["conv_id"] == last["last_id"]) & (lengths["length"] == last["last"]), "left")
    zero = F.lit(0).cast("long")
    return stored(found.select("conv_id", F.col("length").alias("depth"), *[F.coalesce(c, zero).alias(c) for c in ("k1", "k2")],
                               F.coalesce("upto", zero).alias("total")), "trie-ends")


def two_fattest(low: str, high: str) -> Column:
    """The number above ``low``, up to ``high``, that the largest power of two divides."""
    bits = f"length(bin({low} ^ {high})) - 1"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def at_root(names: list[str]) -> list[Column]:
    """The columns of a node for the root, which no path names and which lies below none."""
    return [F.lit({"low": -1, "path": None, "rep": None}.get(c, 0)).cast("long").alias(c) for c in names]


def exits(batch: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``path, low, high, x1, x2, rep``: for each path (``path, length``) the node where it leaves
    the trie.

    Fat binary search over the handles of ``nodes`` finds the deepest node whose extent the path
    goes through, or else the node itself, if its handle already lies on the path.  From the
    former a look at the first turn of the edges below tells the node.
    """
    names = ["low", "high", "x1", "x2", "rep"]
    below = nodes.where("high > 0").select("f", "f1", "f2", "g1", "g2", F.col("low").alias("n_low"), F.col("high").alias("n_high"),
                                           F.col("k1").alias("n_x1"), F.col("k2").alias("n_x2"), F.col("path").alias("n_rep"))
    done = []
    active = batch.select("path", "length", F.lit(0).cast("long").alias("l"), F.col("length").alias("r"), *at_root(names))
    at = rows.select(F.col("path").alias("at_path"), F.col("depth").alias("at_depth"), "k1", "k2")

    def digest_at(frame: DataFrame, depth: str, how: str = "inner") -> DataFrame:
        return frame.join(at, (F.col("path") == F.col("at_path")) & (F.col(depth) == F.col("at_depth")), how).drop("at_path", "at_depth")

    def taken(hit: Column) -> list[Column]:
        return [F.when(hit, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in names]
    while not active.where("l < r").isEmpty():
        done.append(active.where("l >= r"))
        probe = digest_at(active.where("l < r").withColumn("probe", two_fattest("l", "r")), "probe")
        found = probe.join(below, (F.col("probe") == F.col("f")) & (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")), "left")
        hit = F.col("f").isNotNull()
        active = stored(found.select("path", "length", F.when(hit, F.col("n_high")).otherwise(F.col("l")).alias("l"),
                                     F.when(hit, F.col("r")).otherwise(F.col("probe") - 1).alias("r"), *taken(hit)), "trie-search")
    for more in done:
        active = active.unionByName(more)
    through = digest_at(active, "high", "left")
    goes_on = ((F.col("high") == 0) | ((F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2")))) & (F.col("high") < F.col("length"))
    through = through.withColumn("next", F.when(goes_on, F.col("high") + 1)).drop("k1", "k2")
    step = digest_at(through, "next", "left")
    step = step.join(below, (F.col("next") - 1 == F.col("n_low")) & (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left")
    return stored(step.select("path", *taken(F.col("g1").isNotNull())), "trie-exits")


def grown(batch: DataFrame, rows: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``nodes`` with the paths of a batch put in; from an empty trie every path leaves at the root."""
    left = exits(batch, rows, nodes) if nodes is not None else batch.select("path", *at_root(["low", "high", "x1", "x2", "rep"]))
    nodes = root(rows) if nodes is None else nodes
    new = rows.join(left.select(F.col("path").alias("new_path"), F.col("low").alias("above")), F.col("path") == F.col("new_path"))
    new = new.where(F.col("depth") > F.col("above")).select("path", *KEY, "p", "q", "above", (F.col("depth") == F.col("length")).alias("kept"))
    cut = left.where("high > 0").select("low", "high", "x1", "x2", "rep").distinct()
    old = rows.join(cut, (rows["path"] == cut["rep"]) & (rows["depth"] > cut["low"]) & (rows["depth"] <= cut["high"]))
    old = old.select("path", *KEY, "p", "q", F.col("low").alias("above"), (F.col("depth") == F.col("high")).alias("kept"))
    touched = stored(new.unionByName(old), "trie-touched")
    distinct = touched.groupBy(*KEY, "p", "q").agg(F.max("kept").alias("kept"))
    parts = (distinct.groupBy((F.col("depth") - 1).alias("b_depth"), F.col("k1").bitwiseXOR(F.col("p")).alias("b1"),
                              F.col("k2").bitwiseXOR(F.col("q")).alias("b2")).count().where("count > 1").drop("count"))
    tops = distinct.where("kept").select(*KEY).unionByName(parts.where("b_depth > 0").toDF(*KEY)).distinct()
    marked = touched.join(tops.toDF("t_depth", "t1", "t2"),
                          (F.col("depth") == F.col("t_depth")) & (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")))
    # A path may lie on an edge that it is the old name of, as well as on its own.
    marked = marked.groupBy("path", *KEY).agg(F.max("above").alias("above")).withColumn("block", blocks("depth"))
    lowered = running(marked, "path", "block", ["depth"], {"under": ("max", F.col("depth"))}, before=True)
    made = lowered.groupBy(*KEY).agg(F.min("path").alias("path"), F.max(F.greatest(F.coalesce("under", F.lit(0)), "above")).alias("low"))
    made = made.withColumnRenamed("depth", "high").withColumn("f", two_fattest("low", "high"))
    for depth, at in ((F.col("f"), "f"), (F.col("low") + 1, "g")):
        digest = rows.select(F.col("path").alias("h_path"), F.col("depth").alias("h_depth"), F.col("k1").alias(f"{at}1"), F.col("k2").alias(f"{at}2"))
        made = made.join(digest, (F.col("path") == F.col("h_path")) & (depth == F.col("h_depth"))).drop("h_path", "h_depth")
    same = (nodes["high"] == cut["high"]) & (nodes["k1"] == cut["x1"]) & (nodes["k2"] == cut["x2"])
    columns = ["low", "high", "k1", "k2", "path", "f", "f1", "f2", "g1", "g2"]
    return stored(nodes.join(cut.select("high", "x1", "x2"), same, "left_anti").select(*columns).unionByName(made.select(*columns)), "trie-nodes")


def root(rows: DataFrame) -> DataFrame:
    """A trie of the root only."""
    return rows.sparkSession.range(1).select(*at_root(["low", "high", "k1", "k2", "path", "f", "f1", "f2", "g1", "g2"]))


def build(paths: DataFrame, rows: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Stored compacted nodes ``low, high, k1, k2, path, f, f1, f2, g1, g2`` of all paths: the depths
    above and at the extent, the extent, a path with it, the handle, and the first prefix of the edge.

    ``paths`` has ``path, length``; ``rows`` the prefixes of each path.
    """
    nodes = None
    for turn in range(batches):
        part = paths.where((F.pmod(F.xxhash64("path"), F.lit(batches)) == turn) & (F.col("length") > 0))
        nodes = grown(part, rows, nodes)
    return nodes


def id_digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of the ids that end at a prefix.

    Ids are joined to texts by ranges of 65,536 of them, so a frequent sequence is many groups, and
    the texts are hashed in order, one at a time.
    """
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
                if key != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if len(out) > 1_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()
        if now is not None:
            out.append((*now, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    return (chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
            .mapInArrow(of_batches, "depth long, k1 long, k2 long, ends_sha256 string"))


def on_key(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join with a frame that has the columns of a key; they stay once."""
    other = right.select(*[F.col(c).alias(f"r_{c}") if c in KEY else F.col(c) for c in right.columns])
    same = (F.col("depth") == F.col("r_depth")) & (F.col("k1") == F.col("r_k1")) & (F.col("k2") == F.col("r_k2"))
    return left.join(other, same, how).drop("r_depth", "r_k1", "r_k2")


def expanded(paths: DataFrame, rows: DataFrame, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """A row for each node of each depth, with what holds for its subtree.

    ``paths`` has ``path, length, k1, k2, n, total``.
    """
    zero = F.lit(0).cast("long")
    tops = nodes.where("high > 0").select(F.col("high").alias("depth"), "k1", "k2")
    passed = on_key(rows.select("path", *KEY, "upto"), tops)
    passed = stored(passed.unionByName(paths.select("path", *[zero.alias(c) for c in (*KEY, "upto")])), "trie-passed")
    owners = stored(passed.groupBy(*KEY).agg(F.min("path").alias("owner")), "trie-owners")
    last = (on_key(passed, owners).where("owner <> path").groupBy(F.col("path").alias("s_path"))
            .agg(F.max(F.struct("depth", "upto", "owner")).alias("s")))
    known = paths.join(last, paths["path"] == last["s_path"], "left").select(
        "path", "length", "k1", "k2", "n", "total", F.coalesce("s.depth", zero).alias("s_depth"),
        F.coalesce("s.upto", zero).alias("s_upto"), F.col("s.owner").alias("s_owner"))
    owned = rows.join(known.select(F.col("path").alias("o_path"), "s_depth", "s_owner"), F.col("path") == F.col("o_path"))
    owned = stored(owned.where(F.col("depth") > F.col("s_depth")).select("path", *KEY, "p", "q", "chars", "upto", "s_depth", "s_owner"), "trie-owned")
    children = stored(owned.groupBy((F.col("depth") - 1).alias("depth"), F.col("k1").bitwiseXOR(F.col("p")).alias("k1"),
                                    F.col("k2").bitwiseXOR(F.col("q")).alias("k2")).agg(F.count("*").alias("n_children")), "trie-children")
    known = on_key(known.withColumnRenamed("length", "depth"), children, "left")
    known = known.select(F.col("path").alias("k_path"), "n", "total", "s_upto", F.col("n_children").isNull().cast("long").alias("leaf"))
    each = passed.join(known, passed["path"] == known["k_path"])
    sums = each.groupBy(*KEY).agg(
        F.sum("n").alias("n_convs"), F.min("path").alias("owner"), F.sum("leaf").alias("n_leaves"), F.any_value("upto").alias("top_upto"),
        F.sum(F.col("n") * F.col("total")).alias("all_chars"), F.sum(F.col("total") - F.greatest("upto", "s_upto")).alias("below"))
    sums = stored(on_key(on_key(sums, children, "left"), id_digests(ends), "left"), "trie-sums")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    saved = F.col("all_chars") - F.col("below") - F.col("top_upto")

    marked = on_key(owned, tops.withColumn("top", F.lit(True)), "left").withColumn("block", blocks("depth"))
    edges = running(marked, "path", "block", ["depth"], {"high": ("min", F.when(F.col("top"), F.col("depth")))}, backwards=True)
    top = sums.select("owner", F.col("depth").alias("top_depth"), "n_convs", "n_leaves", "all_chars", "below", "top_upto", "n_children", "ends_sha256")
    deep = edges.join(top, (edges["path"] == top["owner"]) & (edges["high"] == top["top_depth"]))
    at_top, over = F.col("depth") == F.col("high"), F.col("upto") - F.col("chars")
    deep = deep.select(
        F.col("path").alias("conv_id"), "depth",
        F.when(F.col("depth") > F.col("s_depth") + 1, F.col("path")).otherwise(F.coalesce("s_owner", "path")).alias("parent_conv_id"),
        "n_convs", F.when(at_top, F.coalesce("n_children", zero)).otherwise(1).alias("n_children"), "n_leaves",
        (saved - (F.col("n_convs") - 1) * over).alias("saved_tokens"),
        F.when(at_top, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"))
    whole = sums.where("depth = 0").select(
        F.col("owner").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    return deep.unionByName(whole)


def conversation_trie(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``
    of every node of the trie of rebuilt conversations."""
    again, lengths = rebuilt(turns(conversations))
    every = prefixes(again)
    ends = ends_of(every, lengths)
    paths = stored(ends.groupBy(*KEY).agg(F.min("conv_id").alias("path"), F.count("*").alias("n"), F.any_value("total").alias("total"))
                   .withColumnRenamed("depth", "length"), "trie-paths")
    named = paths.select("path", "length")
    rows = stored(every.join(named, every["conv_id"] == named["path"]).select("path", *KEY, "p", "q", "chars", "upto", "length"), "trie-rows")
    return expanded(paths, rows, build(named, rows, batches), ends.select("conv_id", *KEY))
