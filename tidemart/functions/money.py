"""Amounts: summed as exact decimals, shown as double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(16,2)"


def money(value: Column) -> Column:
    return value.try_cast(MONEY)


def money_or_zero(value: Column) -> Column:
    return F.coalesce(money(value), F.lit(0).cast(MONEY))


def total(value: Column) -> Column:
    """Exact sum whose result does not hang on the order of the rows."""
    return F.sum(value).cast("double")


def line_amount(price: Column, count: Column) -> Column:
    """Price times piece count as text with two decimals."""
    return (money(price) * count.try_cast("int")).cast("string")
