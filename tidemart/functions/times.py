"""Dates and times as text and as epoch numbers.

Everything follows ``spark.sql.session.timeZone``, for parsing and formatting
alike, so a value survives the round trip.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

from tidemart.fixed import DATE_FORMAT, DATETIME_FORMAT


def date_millis(text: Column) -> Column:
    """``yyyy-MM-dd`` text to epoch milliseconds of its midnight."""
    return F.unix_millis(datetime_of(text))


def datetime_millis(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to epoch milliseconds."""
    return F.unix_millis(datetime_of(text))


def datetime_of(text: Column) -> Column:
    """Timestamp of a date-time text, null if unreadable.

    A cast reads this format several times faster than a pattern does."""
    return text.try_cast("timestamp")


def millis_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATE_FORMAT)


def millis_datetime(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), DATETIME_FORMAT)


def seconds_of(text: Column) -> Column:
    """Timestamp of epoch seconds held as text, as in the change log."""
    return F.timestamp_seconds(text.try_cast("bigint"))


def fraction_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f[ff]Z`` to a timestamp of millisecond precision.

    One or two fraction digits count as tenths or hundredths, so ``.04Z`` and
    ``.040Z`` are the same instant.  The trailing letter names no zone here.
    """
    return F.date_trunc("millisecond", F.regexp_replace(text, "Z$", "").try_cast("timestamp"))


def date_id(value: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp or of a date-time text; null if unreadable."""
    return F.date_format(value.try_cast("timestamp"), DATE_FORMAT)


def day_text(text: Column) -> Column:
    """The part of a date-time text before its first space."""
    return F.split(text, " ")[0]


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))


def window_text(ts: Column) -> Column:
    return F.date_format(ts, DATETIME_FORMAT)


def window_seconds(ts: Column) -> Column:
    """Epoch seconds of a window start, read back from its text form."""
    return F.unix_timestamp(window_text(ts), DATETIME_FORMAT)


def on_day(ts: Column, day: int | None = None) -> Column:
    """Rows of one day given as ``yyyymmdd``, or of today.

    Two comparisons with constants, so that the filter reaches the file scan; a
    formatted date could not.  ``ts`` may be a timestamp or a date-time text.
    """
    date = F.current_date() if day is None else F.lit(datetime.datetime.strptime(str(day), "%Y%m%d").date())
    low, high = (F.date_format(d, f"{DATE_FORMAT} 00:00:00") for d in (date, F.date_add(date, 1)))
    return (ts >= low) & (ts < high)
