"""Equity history: intraday calendars around every past report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.pricing import strike_price
from legweave.market import covered_days, on_days
from legweave.operators.enrich import in_symbols
from legweave.operators.expirations import choose_expirations, common_listing, contract_listing, listing_of_roots, sorted_set
from legweave.operators.filters import enough_dates, strike_corridor
from legweave.operators.legs import earliest_per_day, merge
from legweave.operators.planning import (
    HISTORY_START,
    active_symbols,
    dataset_key,
    for_weeks,
    not_in,
    settled,
    symbol_roots,
    with_quarters,
)
from legweave.schemas import BAR_KEYS, CONTRACT_KEYS
from legweave.scratch import settle
from legweave.sources.scans import of_right

MIN_COMMON_DATES = 5
PLAN_KEYS = ["symbol", "weeks", "fQuarter", "report_date"]
STAMPS = ["filepath", "rQuarter", "noOfEsts", "epsForecast", "fiscalQuarterEnding"]
CONTRACT = ["symbol", "exp", "strike_milli"]


def history_plan(
    reports: DataFrame, symbols: DataFrame, done: DataFrame, weeks: Sequence[int], right: str, as_of: int,
    start: int = HISTORY_START,
) -> DataFrame:
    """Units of work: settled reports of the qualified symbols since ``start``, by weeks, not done or failed.

    ``done`` holds the ``filepath`` of existing outputs and ledger entries.
    """
    rows = in_symbols(reports.filter(F.col("report_date") >= start), symbols)
    plan = with_quarters(for_weeks(settled(rows, as_of), weeks))
    return not_in(plan.withColumn("filepath", dataset_key(right)), done, ["filepath"])


def history_roots(symbols: DataFrame, changes: DataFrame) -> DataFrame:
    """Every (symbol, root) under which market data may be listed, by the active symbol changes."""
    return symbol_roots(symbols, active_symbols(changes))


def plan_strikes(
    plan: DataFrame, quotes: DataFrame, greeks: DataFrame, right: str, roots: DataFrame | None = None
) -> DataFrame:
    """Plan rows with their expirations, shared days and corridor strikes.

    The quotes are listed once, per expiration; the rest reads that listing.
    With ``roots`` both tables are read under every name of a symbol.
    """
    listing = contract_listing(quotes)
    listing = settle(listing if roots is None else listing_of_roots(listing, roots), "listing")
    expirations = listing.groupBy("symbol").agg(sorted_set("exp").alias("expirations"))
    chosen = choose_expirations(plan, expirations)
    shared = settle(common_listing(chosen, listing, MIN_COMMON_DATES), "history-plan")
    days = shared.select(F.explode("trade_dates").alias("trade_date"))
    return strike_corridor(shared, on_days(greeks, days), PLAN_KEYS, right, roots)


def wanted_contracts(ready: DataFrame) -> DataFrame:
    """Contracts of either leg of any plan, with the first and last day they are wanted."""
    sides = [
        ready.select(
            "symbol",
            F.col(f"exp_{leg}").alias("exp"),
            F.explode("strikes").alias("strike_milli"),
            F.array_min("trade_dates").alias("from_day"),
            F.array_max("trade_dates").alias("to_day"),
        )
        for leg in ("front", "back")
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*CONTRACT)
        .agg(F.min("from_day").alias("from_day"), F.max("to_day").alias("to_day"))
    )


def reduced(
    rows: DataFrame, contracts: DataFrame, first: int, last: int, days: DataFrame | None = None
) -> DataFrame:
    """Rows of the wanted contracts on their days; ``first`` and ``last`` bound the scan, ``days`` prune it.

    Contracts with a ``root`` are looked up by that name, and their symbol replaces it.
    """
    contract, spent = CONTRACT, ["from_day", "to_day"]
    if "root" in contracts.columns:
        rows, contract = rows.withColumnRenamed("symbol", "root"), ["root", *CONTRACT[1:]]
        spent.append("root")
    near = rows.filter(F.col("trade_date").between(first, last))
    if days is not None:
        near = on_days(near, days)
    return (
        near.join(contracts, contract)
        .filter(F.col("trade_date").between(F.col("from_day"), F.col("to_day")))
        .drop(*spent)
    )


def equity_history(
    plan: DataFrame, quotes: DataFrame, greeks: DataFrame, oi: DataFrame, right: str, roots: DataFrame | None = None
) -> DataFrame:
    """Quotes, greeks and open interest of both legs for every plan row.

    With ``roots`` the market tables are read under every name of a symbol.
    Each table is cut to the contracts and days of the plans before any of them
    are joined.  Plans give nothing if a leg has no open interest at all, or if
    their result has five trade dates or fewer; single contracts without open
    interest in either leg get 0.
    """
    market = [of_right(t, right) for t in (quotes, greeks, oi)]
    ready = settle(plan_strikes(plan, quotes, market[1], right, roots), "ready")
    contracts = wanted_contracts(ready)
    # The contracts take the names and not the market's rows, so each table is dealt once.
    contracts = settle(contracts if roots is None else contracts.join(roots, "symbol"), "contracts")
    days = contracts.agg(F.min("from_day").alias("first"), F.max("to_day").alias("last")).first()  # one row
    first, last = days.first or 0, days.last or 0
    wanted_days = covered_days(contracts, "from_day", "to_day")
    quoted, greek, interest = (reduced(t, contracts, first, last, wanted_days) for t in market)
    # Quote and greek rows keep their own columns apart only where both have one.
    bars = settle(merge(quoted, greek, BAR_KEYS, "inner", ("_quote", "_ivgreek")), "bars")
    daily_oi = settle(earliest_per_day(interest, CONTRACT_KEYS), "daily-oi")

    values = [n for n in bars.columns if n not in BAR_KEYS]
    leg_keys = ["symbol", "opt_right", "strike_milli", "trade_date", "ms_of_day"]
    wanted = ready.select(
        *PLAN_KEYS,
        *STAMPS,
        "exp_front",
        "exp_back",
        F.array_min("trade_dates").alias("__from"),
        F.array_max("trade_dates").alias("__to"),
        F.explode("strikes").alias("strike_milli"),
    )
    wanted = with_interest_in_both(wanted, daily_oi)
    front = bars.select(
        *leg_keys,
        F.col("exp").alias("exp_front"),
        *[F.col(n).alias("underlying" if n == "underlying" else f"{n}_front") for n in values],
    )
    back = bars.select(
        *leg_keys,
        F.col("exp").alias("exp_back"),
        *[F.col(n).alias(f"{n}_back") for n in values if n != "underlying"],
    )
    legs = (
        front.join(wanted, ["symbol", "exp_front", "strike_milli"])
        .filter(F.col("trade_date").between(F.col("__from"), F.col("__to")))
        .drop("__from", "__to")
        .join(back, [*leg_keys, "exp_back"])
    )
    # Open interest of the pair counts only when both legs have it.
    day_keys = ["symbol", "opt_right", "strike_milli", "trade_date"]
    for leg in ("front", "back"):
        side = daily_oi.select(
            *day_keys, F.col("exp").alias(f"exp_{leg}"), F.col("open_interest").alias(f"open_interest_{leg}")
        )
        legs = legs.join(side, [*day_keys, f"exp_{leg}"], "left")
    both = F.col("open_interest_front").isNotNull() & F.col("open_interest_back").isNotNull()
    result = legs.withColumns(
        {
            "open_interest_front": F.when(both, F.col("open_interest_front")).otherwise(0),
            "open_interest_back": F.when(both, F.col("open_interest_back")).otherwise(0),
            "strike": strike_price("strike_milli"),
        }
    )
    return enough_dates(result, PLAN_KEYS)


def with_interest_in_both(wanted: DataFrame, daily_oi: DataFrame) -> DataFrame:
    """Wanted rows of the plans that have open interest somewhere in either leg."""
    for leg in ("front", "back"):
        held = (
            wanted.select(*PLAN_KEYS, F.col(f"exp_{leg}").alias("exp"), "strike_milli", "__from", "__to")
            .join(daily_oi.select(*CONTRACT, "trade_date"), CONTRACT)
            .filter(F.col("trade_date").between(F.col("__from"), F.col("__to")))
            .select(*PLAN_KEYS)
            .distinct()
        )
        wanted = wanted.join(held, PLAN_KEYS, "left_semi")
    return wanted


def history_failures(plan: DataFrame, result: DataFrame) -> DataFrame:
    """``filepath`` of the plan rows that gave no result, for the ledger of failed work."""
    return not_in(plan, result.select("filepath").distinct(), ["filepath"]).select("filepath").distinct()
