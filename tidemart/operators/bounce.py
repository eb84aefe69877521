"""Bounce detection: an entry page that no further page follows in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.durations import micros
from tidemart.operators.ranged import PART, ROW, ranged, with_next


def bounces(df: DataFrame, key: str, ts: str, is_entry: Column, within: str = "10 seconds",
            ties: Sequence[str] = ()) -> DataFrame:
    """Entry rows whose next row of the same key is itself an entry, comes ``within``
    or more later, or does not exist.

    A visitor with a third of all rows is cut into parts of about equal size, however its rows
    lie in time; see :mod:`tidemart.operators.ranged`.
    """
    at, order = F.unix_micros(ts), [ts, *ties]
    marked = df.withColumn("_entry", F.coalesce(is_entry, F.lit(False)))
    rows = ranged(marked, [key], order)
    following = F.struct(F.col("_entry").alias("entry"), at.alias("at"))
    told = with_next(rows, [key], order, following, "_next")
    left = F.col("_next").isNull() | F.col("_next.entry") | (F.col("_next.at") - at >= micros(within))
    return told.where(F.col("_entry") & left).drop("_entry", "_next", PART, ROW)
