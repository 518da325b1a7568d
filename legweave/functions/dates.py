"""Dates kept as integers (yyyymmdd), quarters, cyclic features, session time."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from legweave.functions.numeric import c

EXCHANGE_ZONE = "America/New_York"


def to_day(x: Column | str) -> Column:
    """Integer yyyymmdd to a date."""
    return F.to_date(c(x).cast("string"), "yyyyMMdd")


def to_yyyymmdd(x: Column | str) -> Column:
    """A date or timestamp to integer yyyymmdd."""
    return F.date_format(c(x), "yyyyMMdd").cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``, both yyyymmdd."""
    return F.datediff(to_day(end), to_day(start))


def quarter_label(day: Column) -> Column:
    """``2024Q1`` for a date column."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def cyclic_time_features(trade_date: Column | str) -> dict[str, Column]:
    """Sine and cosine of day of year, month and weekday (Monday is 0), and the year."""
    day = to_day(trade_date)
    turn = F.lit(2 * math.pi)
    parts = {
        "day": turn * F.dayofyear(day) / F.lit(365),
        "month": turn * F.month(day) / F.lit(12),
        "weekday": turn * F.weekday(day) / F.lit(7),
    }
    features: dict[str, Column] = {}
    for name, angle in parts.items():
        features[f"cos_{name}"] = F.cos(angle)
        features[f"sin_{name}"] = F.sin(angle)
    features["year"] = F.year(day)
    return features


def epoch_to_local_day(epoch_seconds: Column | str, zone: str) -> Column:
    """Epoch seconds to integer yyyymmdd on the wall clock of ``zone``."""
    ts = F.timestamp_seconds(c(epoch_seconds))
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyyMMdd").cast("int")


def in_session(ts: Column | str, start_hour: int, end_hour: int, zone: str = EXCHANGE_ZONE) -> Column:
    """True on weekdays strictly between two whole hours of exchange time.

    ``ts`` is a UTC timestamp.
    """
    local = F.from_utc_timestamp(c(ts), zone)
    midnight = F.date_trunc("day", local)
    start = midnight + F.expr(f"INTERVAL {int(start_hour)} HOURS")
    end = midnight + F.expr(f"INTERVAL {int(end_hour)} HOURS")
    return (F.weekday(local) <= 4) & (local > start) & (local < end)
