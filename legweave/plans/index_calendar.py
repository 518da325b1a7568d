"""Index calendars: all short pairs of expirations, puts and calls side by side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.pricing import midpoint_ms, moneyness, wide_calendar_metrics, wide_iv_diff
from legweave.operators.filters import drop_edge_bars
from legweave.operators.gates import Gate, Watch, key_of
from legweave.operators.ivchain import in_horizon
from legweave.operators.legs import calendar_pairs, merge, widen_put_call
from legweave.operators.quality import underlying_consensus
from legweave.operators.trading_calendar import with_day_counts
from legweave.schemas import BAR_KEYS, CONTRACT_KEYS
from legweave.scratch import settle
from legweave.skew import salted_join
from legweave.sources.csv_scan import drop_null_keys

# Longest span of a pair, both ends counted, and furthest expiration from the trade date.
SNAPSHOT_SPAN_DAYS = 10
RECOVERY_SPAN_DAYS = 45
HORIZON_DAYS = 60


def both_rights(greeks: DataFrame, quotes: DataFrame) -> DataFrame:
    """Greeks and quotes of an expiration, one row per strike."""
    priced = merge(greeks, quotes, CONTRACT_KEYS)
    wide = widen_put_call(priced, ["symbol", "strike_milli", "trade_date", "underlying", "exp"])
    return wide.withColumn("ms_of_day", midpoint_ms("ms_of_day_P", "ms_of_day_C")).drop("ms_of_day_P", "ms_of_day_C")


def _priced_pairs(pairs: DataFrame, holidays: Sequence[int]) -> DataFrame:
    with_money = pairs.withColumn("undPricePctDiff", moneyness("strike_milli", "underlying"))
    metrics = wide_calendar_metrics(with_money, gaps=1)
    to_front = with_day_counts(metrics, holidays, "trade_date", "exp", "fexp")
    return with_day_counts(to_front, holidays, "trade_date", "exp_G1", "bexp", "G1")


@dataclass(frozen=True)
class IndexSnapshot:
    """Calendars of the days whose prices agree, the other days, and the gate that parted them."""

    calendars: DataFrame
    disagreeing: DataFrame
    watch: Watch


def index_snapshot(
    greeks: DataFrame,
    quotes: DataFrame,
    holidays: Sequence[int],
    max_span_days: int = SNAPSHOT_SPAN_DAYS,
    strict: bool = False,
) -> IndexSnapshot:
    """The index snapshot: joined, widened, paired, priced and day-counted.

    Expirations beyond the horizon take no part.  Days on which a symbol's
    expirations disagree about its price give no calendars; they are returned
    with their mean price and deviation, and with ``strict`` they are an error.
    The prices come from a pass over the columns they need; its result, a row
    per symbol and day, is written once.
    """
    day = ["symbol", "trade_date"]
    near = in_horizon(greeks, HORIZON_DAYS)
    watch = Watch([Gate("price_disagreement", ~F.col("agrees"), key_of(*day))])
    prices = near.select(*day, "exp", "strike_milli", "opt_right", "underlying")
    consensus = settle(watch.on(underlying_consensus(prices, day)), "consensus")
    if strict:
        watch.require()
    agreed = consensus.filter("agrees").select(*day)
    wide = both_rights(salted_join(near, agreed, day, "left_semi"), quotes)
    pairs = calendar_pairs(wide, ["symbol", "trade_date", "strike_milli"], max_span_days)
    disagreeing = consensus.filter("NOT agrees").select(*day, "mean_price", "deviation")
    return IndexSnapshot(_priced_pairs(pairs, holidays), disagreeing, watch)


def index_calendars(
    greeks: DataFrame, quotes: DataFrame, holidays: Sequence[int], max_span_days: int = SNAPSHOT_SPAN_DAYS
) -> DataFrame:
    """The calendars of :func:`index_snapshot` alone."""
    return index_snapshot(greeks, quotes, holidays, max_span_days).calendars


def recovered_calendars(
    greeks: DataFrame,
    quotes: DataFrame,
    holidays: Sequence[int],
    from_day: int,
    last_day: int,
    max_front_days: int,
    max_span_days: int = RECOVERY_SPAN_DAYS,
) -> DataFrame:
    """The same from intraday history: bars in the keys, edge bars dropped.

    Trade dates run from ``from_day`` to ``last_day``, both included.

    The edges are found on the joined slice, before puts and calls are matched.
    """
    days = F.col("trade_date").between(from_day, last_day)
    priced = merge(drop_null_keys(greeks.filter(days)), quotes.filter(days), BAR_KEYS)
    inner = drop_edge_bars(priced, ["symbol", "exp", "trade_date"])
    wide = widen_put_call(inner, ["symbol", "strike_milli", "trade_date", "ms_of_day", "underlying", "exp"])
    pairs = calendar_pairs(
        wide,
        ["symbol", "trade_date", "strike_milli", "ms_of_day"],
        max_span_days,
        max_front_days=max_front_days,
        from_day=from_day,
    )
    return wide_iv_diff(_priced_pairs(pairs, holidays), gaps=1)
