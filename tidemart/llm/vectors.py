"""Near-duplicate vectors: PCA-ordered tiles compared dimension by dimension.

Equal vectors are gathered first, with how many they are.  The rest are rotated onto the axes of
their second moments, which leaves cosines as they are and puts the most telling dimensions
first, ordered by the first axes into tiles, and each pair of tiles whose boxes are near enough
is one task's work.  In it the products of the leading dimensions are added up; a pair is given
up as soon as that sum and the product of both suffix norms cannot reach the threshold.  What
is left is compared by the cosine of the given components in double precision.

Tasks add up links per vector and hand on a forest of what is connected, never the pairs.  A
tile that turns out too long is cut by a hash, so no group of near copies is one task's alone.

Defined results: null and empty vectors, zero vectors and vectors with null or non-finite
components link with nothing, as do vectors of different length; each row is a vector of its own,
also where ids are repeated; rows with a null id are linked, but do not name components and
are not kept; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import runs
from tidemart.llm.graph import components
from tidemart.session import stored

COSINE = 0.95
TILE = 8_192
LEADING = 16
BLOCK = 1_024
PAIRS = 1 << 16
SLACK = 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """``embedding, dim, n, low``: distinct vectors that can link, how often and the smallest id."""
    v = F.col("embedding")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return (vectors.where(fine).groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
            .select("embedding", F.size("embedding").alias("dim"), "n", "low"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length as unit vectors."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _by_dim(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        part = batch.take(pa.array(at))
        yield int(dim), _matrix(part.column(column), int(dim)), part


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the axes of the second moments over all vectors, strongest first.

    Every task adds up one matrix; what reaches the driver is one matrix per dimension.
    """
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, unit, _ in _by_dim(batch, "embedding"):
                sums[dim] = sums.get(dim, 0) + unit.T @ unit
        for dim, total in sums.items():
            n = dim * dim
            yield pa.record_batch({"dim": pa.array([dim] * n, pa.int32()), "cell": pa.array(range(n), pa.int32()),
                                   "value": pa.array(total.ravel())})
    cells = (vectors.select("embedding", "dim").mapInArrow(moments, "dim int, cell int, value double")
             .groupBy("dim", "cell").agg(F.sum("value").alias("value")).toArrow())
    axes = {}
    dims, cell, value = (cells.column(k).to_numpy() for k in range(3))
    for dim in np.unique(dims):
        total = np.zeros(dim * dim)
        total[cell[dims == dim]] = value[dims == dim]
        axes[int(dim)] = np.linalg.eigh(total.reshape(dim, dim))[1][:, ::-1].copy()
    return axes


def tiled(vectors: DataFrame, axes: dict[int, np.ndarray], tile: int = TILE) -> DataFrame:
    """Add ``lead`` (coordinates on the first two axes), and ``tile`` by quantiles of the first and,
    inside such a slab, of the second."""
    sent = vectors.sparkSession.sparkContext.broadcast(axes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, unit, part in _by_dim(batch, "embedding"):
                lead = unit @ sent.value[dim][:, :2]
                yield pa.record_batch([*part.columns, pa.array(lead[:, 0]), pa.array(lead[:, min(1, dim - 1)])],
                                      names=[*part.schema.names, "first", "second"])
    schema = "node long, embedding array<double>, dim int, n long, low long, first double, second double"
    rows = stored(vectors.mapInArrow(project, schema), "vectors-projected")
    sides = rows.groupBy("dim").agg(F.ceil(F.sqrt(F.count("*") / tile)).cast("int").alias("side"))
    for axis, keys in (("first", ["dim"]), ("second", ["dim", "slab_first"])):
        parts = F.transform(F.sequence(F.lit(1), F.col("side")), lambda k: k / F.col("side"))
        marks = rows.groupBy(*keys).agg(F.percentile_approx(axis, [i / 256 for i in range(1, 256)], 10_000).alias("marks"))
        cuts = marks.join(sides, "dim").select(*keys, F.when(F.col("side") > 1, F.transform(
            F.slice(parts, 1, F.greatest(F.col("side") - 1, F.lit(1))),
            lambda p: F.element_at("marks", F.greatest(F.lit(1), F.least(F.lit(255), F.round(p * 256).cast("int"))))))
            .otherwise(F.array().cast("array<double>")).alias("cuts"))
        rows = rows.join(cuts, keys).withColumn(
            f"slab_{axis}", F.size(F.filter("cuts", lambda c: c < F.col(axis)))).drop("cuts")
    sized = rows.groupBy("dim", "slab_first", "slab_second").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks"))
    return (rows.join(sized, ["dim", "slab_first", "slab_second"])
            .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            .withColumn("tile", F.struct("dim", "slab_first", "slab_second", "chunk")))


def tile_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """``tile, lo, hi``: pairs of tiles whose boxes are near enough, from both ends.

    Unit vectors with that cosine are at most ``reach`` apart; boxes meet by the strips of that
    width they touch on the first axis.
    """
    reach = (2 - 2 * threshold) ** 0.5 + SLACK
    boxes = rows.groupBy("tile").agg(*[f(c).alias(f"{c}_{n}") for c in ("first", "second")
                                       for f, n in ((F.min, "min"), (F.max, "max"))])
    boxes = stored(boxes.withColumn("name", F.xxhash64("tile")), "vectors-boxes")
    strip = F.explode(F.sequence(F.floor(F.col("first_min") / reach), F.floor(F.col("first_max") / reach) + 1)).alias("strip")
    near = boxes.select("*", strip)
    a, b = near.alias("a"), near.alias("b")

    def gap(axis: str):
        return F.greatest(F.lit(0.0), F.col(f"a.{axis}_min") - F.col(f"b.{axis}_max"),
                          F.col(f"b.{axis}_min") - F.col(f"a.{axis}_max"))
    pairs = (a.join(b, (F.col("a.strip") == F.col("b.strip")) & (F.col("a.tile.dim") == F.col("b.tile.dim"))
                    & (F.col("a.name") <= F.col("b.name")))
             .where(gap("first") * gap("first") + gap("second") * gap("second") <= reach * reach)
             .select(F.col("a.tile").alias("ta"), F.col("b.tile").alias("tb"),
                     F.col("a.name").alias("lo"), F.col("b.name").alias("hi")).distinct())
    pairs = stored(pairs, "vectors-pairs")
    return (pairs.select(F.col("ta").alias("tile"), "lo", "hi")
            .unionAll(pairs.where("lo <> hi").select(F.col("tb").alias("tile"), "lo", "hi")))


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the classes of linked places; ``root`` leads to the smallest place of a class."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, further := root[root]):
            root = further


def near(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs of two blocks; ``ra, rb`` are the rotated rows.

    The sum of products grows by ``LEADING`` dimensions at a time, on the pairs still open.
    """
    dim, at = ra.shape[1], 0
    i = j = total = None
    while True:
        end = min(at + LEADING, dim)
        if total is None:
            total = ra[:, at:end] @ rb[:, at:end].T
            rest = np.sqrt((ra[:, end:] ** 2).sum(axis=1))[:, None] * np.sqrt((rb[:, end:] ** 2).sum(axis=1))[None, :]
            i, j = np.nonzero(total + rest >= threshold - SLACK)
            total = total[i, j]
        else:
            keep = np.empty(len(i), dtype=bool)
            tails = [np.sqrt((r[:, end:] ** 2).sum(axis=1)) for r in (ra, rb)]
            for s in range(0, len(i), PAIRS):
                p = slice(s, s + PAIRS)
                total[p] += np.einsum("ij,ij->i", ra[i[p], at:end], rb[j[p], at:end])
                keep[p] = total[p] + tails[0][i[p]] * tails[1][j[p]] >= threshold - SLACK
            i, j, total = i[keep], j[keep], total[keep]
        at = end
        if at == dim or not len(i):
            break
    linked = np.empty(len(i), dtype=bool)
    for s in range(0, len(i), PAIRS):
        p = slice(s, s + PAIRS)
        linked[p] = np.einsum("ij,ij->i", a[i[p]], b[j[p]]) >= threshold
    return i[linked], j[linked]


def compared(rows: DataFrame, axes: dict[int, np.ndarray], threshold: float = COSINE) -> DataFrame:
    """``a, b, n``: links of vector ``a`` found in a task (``b`` null), and forest edges (``n`` null)."""
    sent = rows.sparkSession.sparkContext.broadcast(axes)

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in (part for found in runs(batches, ["lo", "hi"]) for part in split(found)):
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            mine, dim = table.column("mine").to_numpy(), table.column("dim")[0].as_py()
            unit = _matrix(table.column("embedding").combine_chunks(), dim)
            turned = unit @ sent.value[dim]
            same = table.column("lo")[0] == table.column("hi")[0]
            cut = len(node) if same else int((mine == 0).sum())
            counts, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
            for x in range(0, cut, BLOCK):
                for y in range(x if same else cut, len(node), BLOCK):
                    p, q = slice(x, min(x + BLOCK, cut)), slice(y, y + BLOCK)
                    i, j = near(unit[p], unit[q], turned[p], turned[q], threshold)
                    i, j = i + x, j + y
                    if same and x == y:
                        i, j = i[i < j], j[i < j]
                    np.add.at(counts, i, n[j])
                    np.add.at(counts, j, n[i])
                    root = unite(root, i, j)
            some, led = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(node)))
            yield pa.record_batch({"a": pa.array(np.concatenate([node[some], node[led]])),
                                   "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[root[led]])]),
                                   "n": pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(led), pa.int64())])})

    def split(table: pa.Table) -> Iterator[pa.Table]:
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
        for start, end in zip(starts, [*starts[1:], len(lo)]):
            yield table.slice(int(start), int(end - start))
    pairs = tile_pairs(rows, threshold).withColumnRenamed("tile", "pair_tile")
    sides = rows.join(pairs, rows["tile"] == pairs["pair_tile"]).select(
        "lo", "hi", (F.xxhash64("tile") != F.col("lo")).cast("int").alias("mine"), "node", "n", "dim", "embedding")
    dealt = sides.repartition("lo", "hi").sortWithinPartitions("lo", "hi", "mine", "node")
    return dealt.mapInArrow(of_runs, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = COSINE, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                          vectors["embedding"].cast("array<double>").alias("embedding"))
    groups = stored(usable(rows), "vectors-groups")
    groups = stored(groups.select(F.monotonically_increasing_id().alias("node"), "*"), "vectors-nodes")
    axes = rotations(groups)
    found = stored(compared(stored(tiled(groups, axes, tile), "vectors-tiled"), axes, threshold), "vectors-found")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("link_node")).agg(F.sum("n").alias("more"))
    roots = stored(components(found.where("b IS NOT NULL").select("a", "b")), "vectors-roots")
    named = groups.join(links, groups["node"] == links["link_node"], "left").join(
        roots.withColumnRenamed("node", "root_node"), groups["node"] == F.col("root_node"), "left")
    named = stored(named.select("embedding", "low", F.coalesce("root", groups["node"]).alias("root"),
                                (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "vectors-named")
    least = named.groupBy(F.col("root").alias("least_root")).agg(F.min("low").alias("component_id"))
    named = named.join(least, named["root"] == least["least_root"]).select(
        F.col("embedding").alias("group_embedding"), "n_links", "component_id", F.lit(True).alias("usable"))
    joined = rows.join(named, rows["embedding"] == named["group_embedding"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
