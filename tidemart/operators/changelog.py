"""Projections of the row change log and of change-capture envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart import schemas
from tidemart.fixed import CHANGE_OPS, DELETE, INSERT, UPDATE


def flatten_envelopes(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``type, table, before, after`` of capture envelopes.

    Snapshot and insert records have no ``before``, deletes no ``after``: those come
    out as empty maps.  An unknown operation keeps a null type and two empty maps.
    ``keep`` names further columns to pass on.
    """
    kind = F.lit(None).cast("string")
    for op, name in CHANGE_OPS.items():
        kind = F.when(F.col("op") == op, name).otherwise(kind)
    empty = F.create_map().cast(schemas.STRINGS)

    def image(name: str, kinds: Sequence[str]) -> Column:
        return F.when(kind.isin(*kinds), F.coalesce(F.col(name), empty)).otherwise(empty)

    return df.select(
        kind.alias("type"), F.col("source.table").alias("table"),
        image("before", (UPDATE, DELETE)).alias("before"),
        image("after", [k for k in CHANGE_OPS.values() if k != DELETE]).alias("after"), *keep)


def table_rows(log: DataFrame, table: str, fields: Sequence[str],
               types: Sequence[str] = (), extra: Sequence[str] = ("ts",)) -> DataFrame:
    """Columns of one source table, taken from the row image of its changes."""
    rows = log.where(F.col("table") == table)
    if types:
        rows = rows.where(F.col("type").isin(*types))
    return rows.select(*[F.col("data")[f].alias(f) for f in fields], *extra)


def changed_to(field: str, value: str) -> Column:
    """The update set ``field`` to ``value``: it has that value now and had another."""
    return ((F.col("type") == UPDATE) & (F.col("data")[field] == value)
            & F.col("old")[field].isNotNull())


def increase(field: str) -> tuple[Column, Column]:
    """(filter, amount) of rows that add to a count: inserts with their value, and
    updates that raise it with the difference.  Falling or unchanged counts, and
    updates of other columns, do not pass."""
    now, before = F.col("data")[field].try_cast("int"), F.col("old")[field].try_cast("int")
    inserted = F.col("type") == INSERT
    passes = inserted | ((F.col("type") == UPDATE) & before.isNotNull() & (now > before))
    return passes, F.when(inserted, now).otherwise(now - before)
