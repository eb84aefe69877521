"""Column naming helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lower_camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """``order_id`` becomes ``orderId`` in every column."""
    return df.toDF(*[lower_camel(c) for c in df.columns])


def upper_columns(df: DataFrame) -> DataFrame:
    """Dimension stores that fold names to upper case; Spark resolves either."""
    return df.toDF(*[c.upper() for c in df.columns])
