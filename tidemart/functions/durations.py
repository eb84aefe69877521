"""Durations written as text, such as ``"10 seconds"`` or ``"1 day"``."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_MICROS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
           "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(duration: str) -> int:
    """Length of a duration in microseconds; a leading minus is allowed."""
    match = re.fullmatch(r"\s*(-?\d+)\s+([a-z]+?)s?\s*", duration)
    if not match or match[2] not in _MICROS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match[1]) * _MICROS[match[2]]


def shifted(ts: Column, by: int) -> Column:
    """Timestamp moved by a number of microseconds."""
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(by))


def bucket_start(us: Column, size: int) -> Column:
    """Start of the epoch-aligned bucket that holds an epoch-microsecond value."""
    return us - F.pmod(us, F.lit(size))
