"""Joins whose large side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

_UNHASHABLE = (T.MapType, T.VariantType)


def hot_keys(df: DataFrame, on: Sequence[str], parts: int = 1000) -> DataFrame:
    """The ``parts`` most frequent keys, which include every key with more than a
    ``1 / parts`` share of the rows, and ``_salts``: into how many parts each is to be cut.

    Parts go by rows: none has more than a ``1 / parts`` share of all, and there are at most
    ``2 * parts`` of them.  The row limit is what makes the result safe to broadcast.  Equal
    counts are ordered by key, so each evaluation gives the same keys.
    """
    known = df.where(" and ".join(f"`{c}` is not null" for c in on))
    counts = known.groupBy(*on).agg(F.count("*").alias("_rows"))
    top = counts.orderBy(F.desc("_rows"), *on).limit(parts)
    share = F.col("_rows") * parts / F.sum("_rows").over(Window.partitionBy(F.lit(0)))  # over the limited rows
    return top.select(*on, F.ceil(share).cast("int").alias("_salts"))


def skewed_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                spread: Sequence[str] | None = None, parts: int = 1000) -> DataFrame:
    """Inner or left equi-join that cuts the hot keys of ``big`` by their number of rows.

    Rows of a hot key get a salt from a hash of their ``spread`` columns, and the
    matching rows of ``small`` are repeated once per salt of their key.  All other keys keep
    salt 0, so ``small`` grows by at most ``2 * parts`` times the rows of a key.
    A hash, not a random number, so a task that is run again after an executor is
    lost sends each row to the same place.

    Adaptive execution splits skewed partitions by itself where both sides of the
    join come straight from a shuffle.  This form is for a ``small`` side that is
    an aggregate or a window result, where it cannot.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep the large side whole")
    on = list(on)
    hot = F.broadcast(hot_keys(big, on, parts))
    if spread is None:
        spread = [f.name for f in big.schema.fields
                  if f.name not in on and not isinstance(f.dataType, _UNHASHABLE)
                  and "map<" not in f.dataType.simpleString()
                  and "variant" not in f.dataType.simpleString()]
    salts = F.coalesce("_salts", F.lit(1))
    salt = F.pmod(F.xxhash64(*spread), salts).cast("int") if spread else F.lit(0)
    salted = big.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    repeated = (small.join(hot, on, "left")
                     .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return salted.join(repeated, on + ["_salt"], how).drop("_salt")
