"""Embedding whitening on distributed block matrices.

Entries become whole numbers, ``floor(64 * entry) + 1000000``, so counts, sums and deviations are
exact.  Rows are numbered by file and place in a written table, centred by their exact mean and put
into an MLlib ``BlockMatrix`` of ``BLOCK_ROWS`` rows a block.  Its transpose times itself is the
scatter, added up in ``SPLITS`` parts so that blocks do not meet in one task; the covariance, one
square of the width of a vector, is decomposed on the driver by ``eigh``.  A second ``BlockMatrix``
product by the whitening matrix projects every row, and the same scatter of the result gives the
error against the identity.

Defined results: rows whose vector is null or holds null or non-finite entries are left out, as
are rows with fewer entries than the longest vector that is left, whose missing entries count as
null; entries beyond 2**40 count as 2**40 of their sign; ``deviation`` is null where it does not
fit a long; a component without variance (an eigenvalue below ``RANK`` of the largest) has
``whitened`` null and is left out of the error, which is null if there is none other, and
``explained`` is null where there is no variance at all; each row is a vector of its own, also
where ids are null or repeated; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.session import stored

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 40)
BLOCK_ROWS = 1_024
BLOCK_COLUMNS = 1_024
SPLITS = 64
RANK = 1e-12


def whole_numbers(vector: Column) -> Column:
    """Entries as whole numbers."""
    def number(c: Column) -> Column:
        bounded = F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(bounded * SCALE).cast("long") + SHIFT
    return F.transform(vector, number)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that are left, numbered by ``at`` from 0 on without gaps."""
    v = F.col("embedding")
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = stored(vectors.where(F.size(v) > 0).where(fine).select("vec_id", whole_numbers(v).alias("x")), "whitening-rows")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    rows = stored(rows.where(F.size("x") == F.lit(longest)), "whitening-full")
    placed = rows.select("vec_id", "x", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = placed.groupBy("file").count()  # a row for each task that wrote
    upto = F.sum("count").over(Window.orderBy("file")) - F.col("count")
    begins = files.select(F.col("file").alias("begin_file"), upto.alias("begin"))
    numbered = placed.join(begins, placed["file"] == begins["begin_file"])
    return stored(numbered.select((F.col("begin") + F.col("row")).alias("at"), "vec_id", "x"), "whitening-numbered")


def sums(rows: DataFrame) -> list[int]:
    """Exact sum of each dimension; tasks add up before anything is sent."""
    each = rows.select(F.posexplode("x").alias("dim", "value")).groupBy("dim").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s"))
    return [int(r.s) for r in each.orderBy("dim").collect()]


def literals(numbers: list, kind: str) -> Column:
    return F.array(*[F.lit(str(x) if kind != "double" else float(x)).cast(kind) for x in numbers])


def centred(n: int, total: list[int]) -> Column:
    """Whole ``n * x - s`` of every dimension, null where it does not fit a long."""
    s = literals(total, "decimal(38,0)")
    wide = F.zip_with("x", s, lambda x, t: F.lit(str(n)).cast("decimal(19,0)") * x.cast("decimal(19,0)") - t)
    return F.transform(wide, lambda d: d.try_cast("long"))


def block_matrix(rows: DataFrame, at: str, values: str, n: int, width: int, block_rows: int | None = None) -> BlockMatrix:
    """A frame of numbered arrays as blocks, without Python workers."""
    frame = rows.select(F.col(at).cast("long").alias("index"), array_to_vector(F.col(values)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), n, width).toBlockMatrix(block_rows or BLOCK_ROWS, BLOCK_COLUMNS)


def scatter(blocks: BlockMatrix, splits: int = SPLITS) -> np.ndarray:
    """Transpose times matrix.  The middle dimension, the rows, is cut into ``splits`` parts, which
    the Python method has no argument for."""
    java = blocks._java_matrix_wrapper._java_model
    product = BlockMatrix(java.transpose().multiply(java, splits), blocks.colsPerBlock, blocks.colsPerBlock)
    return product.toLocalMatrix().toArray()


def projected(spark: SparkSession, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``index, whitened``: rows times a matrix of a row for each dimension."""
    right = spark.createDataFrame([(i, row) for i, row in enumerate(matrix.tolist())], "at long, w array<double>")
    product = blocks.multiply(block_matrix(right, "at", "w", *matrix.shape, BLOCK_COLUMNS))
    rows = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("whitened"))


def eigen(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors, one a column."""
    values, vectors = np.linalg.eigh(covariance)
    return values[::-1][:components], vectors[:, ::-1][:, :components]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)
    total = sums(rows)
    width, means = len(total), literals([s / n for s in total], "double")
    whole = rows.select("at", "vec_id", "x", centred(n, total).alias("whole"))
    from_mean = F.zip_with(F.zip_with("whole", F.col("x"), lambda w, x: F.struct(w.alias("w"), x.alias("x"))), means,
                           lambda e, m: F.coalesce(e["w"] / F.lit(n), e["x"] - m))
    squares = F.aggregate("whole", F.lit("0").cast("decimal(38,0)"),
                          lambda a, w: F.try_add(a, F.try_multiply(w.cast("decimal(19,0)"), w.cast("decimal(19,0)"))).cast("decimal(38,0)"))
    rows = stored(whole.select("at", "vec_id", squares.try_cast("long").alias("deviation"), from_mean.alias("c")), "whitening-centred")
    blocks = block_matrix(rows, "at", "c", n, width)
    covariance = scatter(blocks) / n
    values, axes = eigen((covariance + covariance.T) / 2, components)
    trace, k = float(np.trace(covariance)), len(values)
    varied = values > max(RANK * values[0], 0.0)
    stretch = np.where(varied, 1 / np.sqrt(np.where(varied, values, 1.0)), 0.0)
    done = projected(spark, blocks, axes * stretch)
    done = stored(done.join(rows.select("at", "vec_id", "deviation"), F.col("index") == F.col("at"))
                  .select("at", "vec_id", "deviation", "whitened"), "whitening-projected")
    mean = done.select(F.posexplode("whitened").alias("dim", "value")).groupBy("dim").agg(F.avg("value").alias("m")).collect()
    off = literals([r.m for r in sorted(mean)], "double")
    again = scatter(block_matrix(done.select("at", F.zip_with("whitened", off, lambda a, b: a - b).alias("c")), "at", "c", n, k)) / n
    error = float(np.abs(again - np.eye(k))[np.ix_(varied, varied)].max()) if varied.any() else None
    facts = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(bool(varied[i])).alias("varied"),
                               F.lit(float(values[i]) / trace if trace > 0 else None).cast("double").alias("explained")) for i in range(k)])
    each = F.explode(F.zip_with("whitened", facts, lambda w, f: F.struct(
        f["component"].alias("component"), F.when(f["varied"], w).alias("whitened"), f["explained"].alias("explained")))).alias("e")
    return done.select("vec_id", "deviation", each).select(
        "vec_id", F.col("e.component").cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("e.whitened").alias("whitened"), F.col("e.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
