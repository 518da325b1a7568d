"""Equity snapshot: graded symbols with a report ahead, priced and enriched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legweave.functions.pricing import (
    equity_calendar_metrics,
    expected_price,
    iv_front_back_diff,
    strike_price,
    with_leg_spread,
)
from legweave.operators import enrich
from legweave.operators.expirations import choose_expirations, expiration_lists
from legweave.operators.filters import near_the_money, open_interest_above
from legweave.operators.gates import Gate, Watch, key_of
from legweave.operators.ivchain import peak_expirations, peaks_by_right, volatility_chain, with_iv_flags
from legweave.operators.legs import merge
from legweave.operators.trading_calendar import with_day_counts
from legweave.schemas import CONTRACT_KEYS
from legweave.scratch import settle
from legweave.skew import salted_join
from legweave.sources.scans import of_right

LEG_KEYS = ["symbol", "opt_right", "trade_date", "strike_milli"]
MAX_ROWS = 2


def contracts(quotes: DataFrame, greeks: DataFrame, oi: DataFrame) -> DataFrame:
    """Quote, greeks and open interest (if any) of each contract.

    Joining the three tables once per contract, before the legs are matched,
    gives the same rows as joining them per leg, and shuffles each table once.
    """
    return merge(merge(quotes, greeks, CONTRACT_KEYS), oi, CONTRACT_KEYS, "left")


def strategy_plan(earnings: DataFrame, grades: DataFrame, listed: DataFrame) -> DataFrame:
    """(symbol, weeks, report_date) of graded symbols with their two expirations, for reports ahead."""
    graded = enrich.grades_with_earnings(enrich.plan_grades(grades), earnings)
    return choose_expirations(graded.select("symbol", "weeks", "report_date"), expiration_lists(listed))


def of_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of the expirations that some plan row wants."""
    wanted = plan.select("symbol", F.col("exp_front").alias("exp")).union(plan.select("symbol", "exp_back")).distinct()
    return rows.join(wanted, ["symbol", "exp"], "left_semi")


def matched_legs(plan: DataFrame, rows: DataFrame) -> DataFrame:
    """Both legs of every plan row; underlying and time come from the front leg."""
    values = [n for n in rows.columns if n not in (*LEG_KEYS, "exp")]
    shared = {"underlying", "ms_of_day"}
    front = rows.select(
        *LEG_KEYS,
        F.col("exp").alias("exp_front"),
        *[F.col(n).alias(n if n in shared else f"{n}_front") for n in values],
    )
    back = rows.select(
        *LEG_KEYS, F.col("exp").alias("exp_back"), *[F.col(n).alias(f"{n}_back") for n in values if n not in shared]
    )
    return salted_join(front, plan, ["symbol", "exp_front"]).join(back, [*LEG_KEYS, "exp_back"])


def priced_snapshot(
    plan: DataFrame, quotes: DataFrame, greeks: DataFrame, oi: DataFrame, right: str, min_oi: int = 0
) -> DataFrame:
    """Near-the-money calendars of the plan with their prices.

    Each table is cut to the plan's expirations before they are joined.
    """
    cut = [of_plan(of_right(t, right), plan) for t in (quotes, greeks, oi)]
    legs = matched_legs(plan, contracts(*cut))
    priced = equity_calendar_metrics(legs)
    for leg in ("front", "back"):
        priced = with_leg_spread(priced, leg)
    priced = priced.withColumns(
        {
            "strike": strike_price("strike_milli"),
            "undPricePctDiff": F.try_divide(F.col("strike_milli") / 1000 - F.col("underlying"), F.col("underlying")),
            "iv_pct_diff": iv_front_back_diff("implied_vol_front", "implied_vol_back"),
        }
    )
    return near_the_money(
        open_interest_above(priced, min_oi), ["symbol", "weeks", "opt_right", "trade_date"], MAX_ROWS
    )


def equity_snapshot(
    quotes: DataFrame,
    greeks: DataFrame,
    oi: DataFrame,
    earnings: DataFrame,
    grades: DataFrame,
    cost_stats: DataFrame,
    holidays: Sequence[int],
    right: str = "C",
    watch: Watch | None = None,
) -> DataFrame:
    """The whole snapshot of every trade date in the tables, up to the features.

    Only reports within 20 business days take part, in the plan and joined back
    by symbol.  Open interest is joined per leg, so a leg without it leaves the
    other one's intact: a choice of ours, where joining the pair first would
    empty both.  ``watch`` (a :func:`snapshot_watch`) counts rows that break the
    snapshot's gates while whoever reads the result does so.
    """
    earnings = enrich.upcoming(earnings)
    plan = settle(strategy_plan(earnings, grades, quotes), "snapshot-plan")
    snap = priced_snapshot(plan, quotes, greeks, oi, right)
    snap = enrich.with_earnings_and_grades(snap, earnings, enrich.plan_grades(grades))
    snap = expected_price(enrich.with_cost_stats(snap, enrich.latest_cost_stats(cost_stats)))
    # Only the plan's symbols have calendars to flag.
    of_symbols = greeks.join(plan.select("symbol").distinct(), "symbol", "left_semi")
    peaks = peaks_by_right(peak_expirations(volatility_chain(of_symbols)))
    snap = with_iv_flags(snap, peaks)
    counted = with_day_counts(snap, holidays, "trade_date", "exp_front", "fexp")
    return counted if watch is None else watched(counted, watch)


def snapshot_watch() -> Watch:
    """Gates of a snapshot: one row per strike, one price per symbol and day, legs in order, a cost."""
    key = key_of("symbol", "weeks", "trade_date", "strike_milli")
    return Watch(
        [
            Gate("strike_repeats", F.col("__repeats") > 1, key),
            Gate("several_prices", F.col("__low") != F.col("__high"), key),
            Gate("legs_out_of_order", F.col("exp_front") >= F.col("exp_back"), key),
            Gate("no_cost", F.col("calCost").isNull(), key),
        ]
    )


def watched(snapshot: DataFrame, watch: Watch) -> DataFrame:
    """The snapshot with the watch on it; its few rows per symbol and day are counted by windows."""
    strikes = Window.partitionBy("symbol", "trade_date", "weeks", "opt_right", "strike_milli")
    prices = Window.partitionBy("symbol", "trade_date")
    counted = snapshot.withColumns(
        {
            "__repeats": F.count(F.lit(1)).over(strikes),
            "__low": F.min("underlying").over(prices),
            "__high": F.max("underlying").over(prices),
        }
    )
    return watch.on(counted).drop("__repeats", "__low", "__high")
