"""First, latest and daily rows per key, and ordinals inside a key.

None of these sends all rows of a key to one task.  ``row_number() = 1`` is
planned by Spark with a group limit below the shuffle, so each input task passes
on at most one row per key; counts and minima are combined there as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.times import day_gap
from tidemart.operators.ranged import PART, ROW, ranged, with_place
from tidemart.operators.skew import skewed_join


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key.  Give a total order, or ties are broken at random."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def latest_by_key(df: DataFrame, keys: Sequence[str], version: Sequence[str],
                  ties: Sequence[str] = ()) -> DataFrame:
    """The row with the highest version per key; equal versions fall back to ``ties``."""
    return first_by_key(df, keys, [F.col(c).desc() for c in version] + [F.col(c) for c in ties])


def daily_first(df: DataFrame, keys: Sequence[str], ts: str,
                ties: Sequence[str] = (), day: str = "date") -> DataFrame:
    """First row per key and calendar day, with the day as a column."""
    dated = df.withColumn(day, F.to_date(F.col(ts)))
    return first_by_key(dated, [*keys, day], [ts, *ties])


def first_times(df: DataFrame, keys: Sequence[str], ts: str, day: str = "date",
                day_of: Column | None = None) -> DataFrame:
    """``*keys, day, ts`` of each key's first row per day, when no other column counts.

    A hash aggregate on a fixed-width minimum: no sort, and one row per key, day
    and input task in the shuffle.
    """
    dated = df.withColumn(day, F.to_date(F.col(ts)) if day_of is None else day_of)
    return dated.groupBy(*keys, day).agg(F.min(ts).alias(ts))


def new_and_daily(days: DataFrame, user: str, day: str = "date") -> DataFrame:
    """Mark the first day of each user in a frame of one row per user and day.

    The window runs over days, not over source rows: a user has at most as many
    rows here as the data has days.
    """
    first_day = F.min(day).over(Window.partitionBy(user))
    return days.withColumn("is_first_day", (F.col(day) == first_day).cast("bigint"))


def returning(days: DataFrame, user: str, day: str = "date", gap: int = 7) -> DataFrame:
    """Add ``is_back``: more than ``gap`` days since the user's last day before."""
    before = F.lag(day).over(Window.partitionBy(user).orderBy(day))
    back = F.coalesce(day_gap(F.col(day), before) > gap, F.lit(False))
    return days.withColumn("is_back", back.cast("bigint"))


def ordinals(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
             out: str = "ordinal") -> DataFrame:
    """1-based place of each row within its key, ordered by ``ts`` then ``order``.

    A plain ``row_number`` would put all rows of a key in one task.  Here a busy key is
    cut into parts of about equal size; see :mod:`tidemart.operators.ranged`.
    """
    rows = ranged(df, keys, [ts, *order])
    return with_place(rows, keys, [ts, *order], out).drop(PART, ROW)


def toggle(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """Keep the 1st, 3rd, 5th … occurrence of each key."""
    placed = ordinals(df, keys, ts, order, out="_place")
    return placed.where(F.col("_place") % 2 == 1).drop("_place")


def fix_is_new(df: DataFrame, key: str, flag: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """Correct a new-visitor flag: ``'1'`` holds only on the day of a visitor's first
    row, and only if that first row carried it.

    Rows that do not carry ``'1'`` never change and pass without a shuffle.  The
    first rows are a grouped result, so the join splits hot visitors itself.
    """
    anchor = first_by_key(df.select(key, flag, ts, *ties), [key], [ts, *ties]).select(
        key, (F.col(flag) == "1").alias("_was_new"), F.to_date(F.col(ts)).alias("_day"))
    marked = df.where(F.col(flag) == "1")
    others = df.where(~F.col(flag).eqNullSafe("1"))
    joined = skewed_join(marked, anchor, [key], "left", spread=[ts, *ties])
    stale = (~F.coalesce(F.col("_was_new"), F.lit(False))
             | (F.to_date(F.col(ts)) != F.col("_day"))) & F.col("_day").isNotNull()
    fixed = joined.withColumn(flag, F.when(stale, F.lit("0")).otherwise(F.col(flag)))
    return fixed.select(*df.columns).unionByName(others)
