"""Distinct counts over sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.durations import bucket_start, micros
from tidemart.functions.times import window_text


def _panes(df: DataFrame, ts: str, slide: str) -> DataFrame:
    return df.withColumn("_pane", bucket_start(F.unix_micros(ts), micros(slide)))


def _covered(df: DataFrame, size: str, slide: str) -> DataFrame:
    """Repeat each pane for the windows that cover it."""
    long, step = micros(size), micros(slide)
    if long % step:
        raise ValueError("window size is not a multiple of its slide")
    starts = F.sequence(F.col("_pane") - (long - step), F.col("_pane"), F.lit(step))
    return df.withColumn("_start", F.explode(starts)).drop("_pane")


def _shown(df: DataFrame, size: str, keys: Sequence[str]) -> DataFrame:
    start = F.col("_start")
    return df.select(window_text(F.timestamp_micros(start)).alias("stt"),
                     window_text(F.timestamp_micros(start + micros(size))).alias("edt"),
                     *keys, "ct")


def distinct_exact(df: DataFrame, ts: str, keys: Sequence[str], value: str, size: str,
                   slide: str) -> DataFrame:
    """Exact distinct count per sliding window and key.

    Rows are first reduced to distinct values per pane of one slide; only those are
    repeated for the windows that cover the pane.
    """
    panes = _panes(df, ts, slide).select(*keys, "_pane", value).distinct()
    counted = _covered(panes, size, slide).groupBy("_start", *keys).agg(
        F.count_distinct(value).alias("ct"))
    return _shown(counted, size, keys)


def distinct_sketch(df: DataFrame, ts: str, keys: Sequence[str], value: str, size: str,
                    slide: str, precision: int = 14) -> DataFrame:
    """Estimated distinct count per sliding window and key.

    One sketch per pane and key, a few kilobytes whatever the number of rows; windows
    merge the sketches of their panes.  The standard error is near 1 % at precision 14.
    """
    sketches = _panes(df, ts, slide).groupBy("_pane", *keys).agg(
        F.hll_sketch_agg(value, F.lit(precision)).alias("_sketch"))
    merged = _covered(sketches, size, slide).groupBy("_start", *keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias("ct"))
    return _shown(merged, size, keys)
