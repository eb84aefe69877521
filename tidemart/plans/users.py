"""Registration and login jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.fixed import INSERT, USER_INFO
from tidemart.functions.times import date_id, seconds_of
from tidemart.operators.changelog import table_rows
from tidemart.operators.keyed import first_times, returning
from tidemart.operators.windows import windowed
from tidemart.plans.traffic import entries


def register_detail(log: DataFrame) -> DataFrame:
    """``user_id, date_id, create_time, ts`` of new users."""
    rows = table_rows(log, USER_INFO, ["id", "create_time"], [INSERT])
    return rows.select(F.col("id").alias("user_id"), date_id(F.col("create_time")).alias("date_id"),
                       "create_time", "ts")


def register_window(registered: DataFrame, size: str = "10 seconds") -> DataFrame:
    """New users per window of the change time."""
    return register_totals(registered.withColumn("event_time", seconds_of(F.col("ts"))), size)


def register_totals(timed: DataFrame, size: str) -> DataFrame:
    return windowed(timed, "event_time", size, [F.count("*").alias("register_ct")])


def logins(pages: DataFrame) -> DataFrame:
    """``uid, event_time`` of entry pages of known users."""
    known = entries(pages).where(F.col("common.uid").isNotNull())
    return known.select(F.col("common.uid").alias("uid"), "event_time")


def login_window(pages: DataFrame, size: str = "10 seconds", gap: int = 7) -> DataFrame:
    """Users per window of their first login of the day, and among them those back
    after more than ``gap`` days."""
    return login_totals(returning(first_times(logins(pages), ["uid"], "event_time"), "uid", gap=gap), size)


def login_totals(days: DataFrame, size: str) -> DataFrame:
    return windowed(days, "event_time", size, [F.sum("is_back").alias("back_ct"),
                                               F.count("*").alias("uu_ct")])
