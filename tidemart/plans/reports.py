"""Dashboard queries on the window results.

``stt`` is the window start as text.  A day is given as ``yyyymmdd``; none means today.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.times import on_day


def gmv(provinces: DataFrame, day: int | None = None) -> DataFrame:
    """Sales of a day, rounded half up to cents; null if there were none."""
    amount = F.sum(F.col("order_amount").cast("decimal(16,2)"))
    return provinces.where(on_day(F.col("stt"), day)).agg(
        F.round(amount, 2).cast("double").alias("gmv"))


def visitors_by_channel(views: DataFrame, day: int | None = None) -> DataFrame:
    """Unique visitors of a day per channel, largest first."""
    return (views.where(on_day(F.col("stt"), day)).groupBy("ch")
                 .agg(F.sum("uv_ct").alias("uv")).orderBy(F.desc("uv"), "ch"))


def orders_by_province(provinces: DataFrame, day: int | None = None) -> DataFrame:
    """Map points of a day: amount as value, order count as size and tooltip."""
    size = F.sum("order_count")
    amount = F.sum(F.col("order_amount").cast("decimal(16,2)")).cast("double")
    return (provinces.where(on_day(F.col("stt"), day))
            .groupBy(F.col("province_name").alias("name"))
            .agg(amount.alias("value"), size.alias("size_value"))
            .withColumn("tooltip_values", F.array("size_value")))
