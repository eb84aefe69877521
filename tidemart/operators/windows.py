"""Tumbling and sliding event-time windows with their bounds as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.times import window_text


def windowed(df: DataFrame, ts: str | Column, size: str, aggs: Sequence[Column],
             keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """``stt, edt, *keys, *aggs`` per window and key.

    The aggregates are combined inside each input task before the shuffle, so a
    key that holds a third of the rows costs one row per task, and the unkeyed
    form is no bottleneck either.  Works on a stream with a watermark on ``ts``.
    """
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(span.alias("_span"), *keys).agg(*aggs)
    return bounds(grouped, "_span")


def bounds(df: DataFrame, span: str) -> DataFrame:
    """Replace a window column by its start and end as text, in front."""
    rest = [F.col(c) for c in df.columns if c != span]
    return df.select(window_text(F.col(span).start).alias("stt"),
                     window_text(F.col(span).end).alias("edt"), *rest)


def stamped(df: DataFrame) -> DataFrame:
    """Add the row version ``ts``: the time of the computation in milliseconds."""
    return df.withColumn("ts", F.unix_millis(F.current_timestamp()))
