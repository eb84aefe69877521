"""Order inside a key that may hold a third of all rows.

Rows are dealt by ranges of key, time and ties, which Spark draws so that the parts are of about
one size; a busy key gets as many parts as its rows need, wherever in time they lie.  What a row
needs from outside its part is one row or one number for each part of its key, added by a window
over the parts and not over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.session import stored

PART, ROW = "_part", "_row"


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stored rows with their part; rows equal in ``keys`` and ``order`` may be in two of them.

    The parts are written, because all that is computed from them must see the same ones.
    """
    numbered = df.withColumn(ROW, F.monotonically_increasing_id())
    return stored(numbered.repartitionByRange(*keys, *order, ROW).withColumn(PART, F.spark_partition_id()), "ranged")


def _joined(rows: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what their part has, null keys included."""
    same = rows[PART] == parts["_of_part"]
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(parts[f"_of_{i}"])
    return rows.join(parts, same)


def _of(keys: Sequence[str]) -> list[Column]:
    return [F.col(PART).alias("_of_part"), *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)]]


def with_next(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``value`` of the next row of the key; ``value`` must not be null."""
    inside = Window.partitionBy(*keys, PART).orderBy(*order, ROW)
    first = rows.groupBy(*keys, PART).agg(F.min_by(value, F.struct(*order, ROW)).alias("_first"))
    over = Window.partitionBy(*keys).orderBy(PART)
    edges = first.select(*_of(keys), F.lead("_first").over(over).alias("_after"))
    told = _joined(rows.withColumn("_inside", F.lead(value).over(inside)), edges, keys)
    return told.select(*rows.columns, F.coalesce("_inside", "_after").alias(name))


def with_place(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add the 1-based place of each row in its key."""
    inside = Window.partitionBy(*keys, PART).orderBy(*order, ROW)
    sizes = rows.groupBy(*keys, PART).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*_of(keys), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = _joined(rows.withColumn("_inside", F.row_number().over(inside)), before, keys)
    return placed.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
