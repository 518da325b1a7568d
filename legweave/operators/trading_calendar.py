"""Trading days counted in closed form from a list of holidays."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.functions.dates import days_between, to_day, to_yyyymmdd
from legweave.functions.numeric import c

# Names of the (business, calendar) day counts by what is counted to.
DAY_COUNT_NAMES = {
    "earnings": ("bdte", "dte"),
    "fexp": ("bdtfexp", "dtfexp"),
    "bexp": ("bdtbexp", "dtbexp"),
    "dit": ("bdit", "dit"),
}


# A Monday; trading days are counted from here on either side.
FIRST_MONDAY = date(1970, 1, 5)


def open_days_before(day: Column | str, holidays: Iterable[int]) -> Column:
    """Trading days before ``day`` (yyyymmdd) since FIRST_MONDAY, negative before it.

    Whole weeks have five of them, a rest of a week one per weekday, less the
    holidays on weekdays.  It needs no table and knows every date.
    """
    shut = sorted(h for h in set(holidays) if _as_date(h).weekday() < 5)
    days = F.datediff(to_day(day), F.lit(FIRST_MONDAY))
    weekdays = F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(5))
    after = [h for h in shut if _as_date(h) >= FIRST_MONDAY]
    early = [h for h in shut if _as_date(h) < FIRST_MONDAY]
    out = weekdays
    if after:
        out = out - F.size(F.filter(F.array(*[F.lit(h) for h in after]), lambda h: h < c(day)))
    if early:
        out = out + F.size(F.filter(F.array(*[F.lit(h) for h in early]), lambda h: h >= c(day)))
    return out.cast("int")


def _as_date(day: int) -> date:
    return date(day // 10_000, day // 100 % 100, day % 100)


def span_bounds(df: DataFrame, start: Column | str, *ends: Column | str) -> DataFrame:
    """One row (``first_day``, ``last_day``): the smallest start and largest end."""
    last = [F.max(c(e)) for e in ends]
    return df.agg(
        F.min(c(start)).alias("first_day"),
        (F.greatest(*last) if len(last) > 1 else last[0]).alias("last_day"),
    )


def calendar_over(bounds: DataFrame, holidays: Iterable[int]) -> DataFrame:
    """Every day of the span: ``day``, ``is_open``, ``idx``.

    ``idx`` counts the trading days of the span strictly before the day, which
    is the position a left search in the sorted trading days would return.
    """
    holidays = sorted(set(holidays))
    days = bounds.select(
        "first_day", F.explode(F.sequence(to_day("first_day"), to_day("last_day"))).alias("d")
    )
    day = to_yyyymmdd("d")
    is_open = F.weekday("d") <= 4
    if holidays:
        is_open = is_open & ~day.isin(*holidays)
    idx = open_days_before(day, holidays) - open_days_before("first_day", holidays)
    return days.select(day.alias("day"), is_open.alias("is_open"), idx.alias("idx"))


def calendar_index(spark: SparkSession, first_day: int, last_day: int, holidays: Iterable[int]) -> DataFrame:
    """:func:`calendar_over` for a span known up front."""
    bounds = spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))
    return calendar_over(bounds, holidays)


def trading_days(calendar: DataFrame) -> DataFrame:
    """The open days of a calendar."""
    return calendar.filter("is_open").select("day")


def with_day_counts(
    df: DataFrame,
    holidays: Iterable[int],
    start: str,
    end: str,
    target: str,
    suffix: str | None = None,
) -> DataFrame:
    """Business and calendar days from ``start`` to ``end`` (both yyyymmdd).

    Counts trading days in [start, end); negative when the end comes first.
    """
    business, days = (f"{n}_{suffix}" if suffix else n for n in DAY_COUNT_NAMES[target])
    holidays = list(holidays)
    count = open_days_before(end, holidays) - open_days_before(start, holidays)
    return df.withColumns({business: count, days: days_between(start, end)})
