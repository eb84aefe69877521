"""Lookups and the event-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.durations import bucket_start, micros
from tidemart.functions.times import window_text
from tidemart.operators.keyed import latest_by_key
from tidemart.operators.skew import skewed_join


def lookup(facts: DataFrame, dim: DataFrame, key: str, dim_key: str,
           columns: dict[str, str], how: str = "inner") -> DataFrame:
    """Add dimension columns; ``columns`` maps a new name to a dimension column.

    A fact without its dimension row is left out by default, or kept with nulls
    with ``how="left"``.  There is no broadcast hint on purpose: Spark broadcasts
    the dimension if its size is below ``spark.sql.autoBroadcastJoinThreshold``
    (checked again at run time), and else shuffles both sides and splits hot keys.
    With a streaming ``facts`` the files of a static ``dim`` are those of the time when ``dim``
    was made: read it anew inside ``foreachBatch`` where it may change.
    """
    side = dim.select(F.col(dim_key).alias("_key"),
                      *[F.col(source).alias(name) for name, source in columns.items()])
    return facts.join(side, facts[key] == F.col("_key"), how).drop("_key")


def decode(facts: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the dictionary name of a code column; an unknown code gives null."""
    return lookup(facts, dictionary, code, "dic_code", {name: "dic_name"}, "left")


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join whose *right* side may be heavy on one key.

    An outer join cannot split its right side, an inner join can.  So matches come
    from an inner join, and the rows without a match from an anti join against the
    distinct keys, which are combined before their shuffle.  Column names must differ.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key))
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    alone = left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def flatten_catalog(sku: DataFrame, trademark: DataFrame, category3: DataFrame,
                    category2: DataFrame, category1: DataFrame,
                    spu: DataFrame | None = None) -> DataFrame:
    """One row per sku with its spu, brand and three category levels.

    The snowflake is joined once among the dimensions, so facts need one lookup
    instead of five or six.
    """
    flat = sku.select(F.col("id").alias("sku_id"), F.col("spu_id"),
                      F.col("tm_id").alias("trademark_id"), F.col("category3_id"))
    if spu is not None:
        flat = lookup(flat, spu, "spu_id", "id", {"spu_name": "spu_name"})
    flat = lookup(flat, trademark, "trademark_id", "id", {"trademark_name": "tm_name"})
    flat = lookup(flat, category3, "category3_id", "id",
                  {"category3_name": "name", "category2_id": "category2_id"})
    flat = lookup(flat, category2, "category2_id", "id",
                  {"category2_name": "name", "category1_id": "category1_id"})
    return lookup(flat, category1, "category1_id", "id", {"category1_name": "name"})


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower: str = "-5 seconds", upper: str = "5 seconds") -> DataFrame:
    """Pairs of one key with ``left_ts + lower <= right_ts <= left_ts + upper``.

    Time is cut into buckets as wide as the interval.  A left row sits in one, a
    right row is sent to the one or two that its partners can sit in, and the join
    is an equality on key and bucket: a hot key is spread over time and no pair
    that is too far apart is ever formed.  Column names must differ but for ``key``.
    """
    low, high = micros(lower), micros(upper)
    if high < low:
        raise ValueError("upper bound below lower bound")
    size = max(high - low, 1)
    left_at, right_at = F.unix_micros(left_ts), F.unix_micros(right_ts)
    lefts = left.withColumn("_bucket", bucket_start(left_at, size))
    rights = right.withColumn("_bucket", F.explode(F.array_distinct(F.array(
        bucket_start(right_at - high, size), bucket_start(right_at - low, size)))))
    apart = F.unix_micros(right_ts) - F.unix_micros(left_ts)
    return (lefts.join(rights, [key, "_bucket"]).where(apart.between(low, high))
                 .drop("_bucket"))


def stream_interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                         left_ts: str, right_ts: str, lower: str = "-5 seconds",
                         upper: str = "5 seconds", delay: str = "0 seconds") -> DataFrame:
    """Streaming form: the time bound lets Spark drop buffered rows by watermark."""
    lefts, rights = left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay)
    from_, to = F.make_dt_interval(secs=F.lit(micros(lower) / 1e6)), \
        F.make_dt_interval(secs=F.lit(micros(upper) / 1e6))
    return lefts.join(rights, (F.col(left_key) == F.col(right_key))
                      & (F.col(right_ts) >= F.col(left_ts) + from_)
                      & (F.col(right_ts) <= F.col(left_ts) + to))


def _with_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    return df.withColumn("_start", bucket_start(F.unix_micros(ts), micros(size)))


def _bounds_in_front(df: DataFrame, size: str, rest: Sequence[str]) -> DataFrame:
    start = F.col("_start")
    return df.select(window_text(F.timestamp_micros(start)).alias("stt"),
                     window_text(F.timestamp_micros(start + micros(size))).alias("edt"), *rest)


def window_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                size: str = "5 seconds") -> DataFrame:
    """Pairs of one key whose times fall into the same tumbling window."""
    joined = _with_window(left, left_ts, size).join(
        _with_window(right, right_ts, size), [key, "_start"])
    rest = [key] + [c for c in left.columns + right.columns if c != key]
    return _bounds_in_front(joined, size, rest)


def window_cogroup(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                   left_aggs: Sequence[Column], right_aggs: Sequence[Column],
                   size: str = "5 seconds") -> DataFrame:
    """One row per key and window that either side has rows in, with an aggregate of
    each side.

    Each side is aggregated before the outer join (and before its own shuffle), so
    nothing is collected.  Pass ``F.collect_list`` for the plain lists; a list is
    held in memory, so keep the window short then.
    """
    lefts = _with_window(left, left_ts, size).groupBy(key, "_start").agg(*left_aggs)
    rights = _with_window(right, right_ts, size).groupBy(key, "_start").agg(*right_aggs)
    both = lefts.join(rights, [key, "_start"], "full")
    return _bounds_in_front(both, size, [c for c in both.columns if c != "_start"])


def latest_partner(details: DataFrame, orders: DataFrame, key: str, order_ts: str,
                   ties: Sequence[str] = ()) -> DataFrame:
    """Every detail with the latest order of its key, or with nulls.

    Batch form of the two-input join that keeps one order per key and holds back
    details until it arrives.  Details may be heavy on one order: the join splits it.
    """
    return skewed_join(details, latest_by_key(orders, [key], [order_ts], ties), [key], "left")
