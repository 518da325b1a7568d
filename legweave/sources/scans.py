"""Scans of the quote, greek and open-interest tables.

Each is a filter and a projection on one table, so both reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.pricing import mark
from legweave.market import covered_days, on_days
from legweave.schemas import QUOTE_EXTRAS
from legweave.skew import salted_join

BOTH_RIGHTS = "PC"


def of_right(df: DataFrame, right: str) -> DataFrame:
    """Rows of one right; ``PC`` (or anything but C or P) keeps both."""
    return df.filter(F.col("opt_right") == right) if right in ("C", "P") else df


def scan_greeks(greeks: DataFrame, right: str = BOTH_RIGHTS) -> DataFrame:
    return of_right(greeks, right).drop("bid", "ask", "ms_of_day")


def scan_quotes(quotes: DataFrame, right: str = BOTH_RIGHTS) -> DataFrame:
    """Quotes without exchange details, with their mark."""
    return of_right(quotes, right).drop(*QUOTE_EXTRAS).withColumn("mark", mark("bid", "ask"))


def scan_open_interest(oi: DataFrame, right: str = BOTH_RIGHTS) -> DataFrame:
    return of_right(oi, right).drop("ms_of_day", "trade_date")


def history_slices(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of the requested contracts and periods.

    ``requests`` holds symbol, exp, strike_milli, opt_right, start_date and
    end_date.  All requests are answered by one scan and one join; a request
    without data gives no rows.  Of a table partitioned by trade date only the
    days that some request covers are read.
    """
    keys = ["symbol", "exp", "strike_milli", "opt_right"]
    near = on_days(rows, covered_days(requests, "start_date", "end_date"))
    hits = salted_join(near, requests, keys)
    return hits.filter(F.col("trade_date").between(F.col("start_date"), F.col("end_date"))).drop(
        "start_date", "end_date"
    )
