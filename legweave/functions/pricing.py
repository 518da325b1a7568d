"""Price and volatility formulas as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.functions.numeric import c, round_half_even, safe_divide

RIGHTS = ("C", "P")


def mark(bid: Column | str, ask: Column | str) -> Column:
    return (c(ask) - c(bid)) / 2 + c(bid)


def with_leg_spread(df: DataFrame, leg: str) -> DataFrame:
    """``spread_<leg>`` and ``spreadPct_<leg>`` from that leg's bid, ask and mark."""
    spread = c(f"ask_{leg}") - c(f"bid_{leg}")
    return df.withColumns(
        {
            f"spread_{leg}": spread,
            f"spreadPct_{leg}": round_half_even(safe_divide(spread, f"mark_{leg}"), 2),
        }
    )


def strike_price(strike_milli: Column | str) -> Column:
    """Strike in thousandths to a price with two digits."""
    return round_half_even(c(strike_milli) / 1000, 2)


def moneyness(strike_milli: Column | str, underlying: Column | str) -> Column:
    """Relative distance of the strike from the underlying, single precision."""
    return safe_divide(c(strike_milli) / 1000 - c(underlying), underlying).cast("float")


def strike_pct_from_underlying(strike: Column | str, underlying: Column | str) -> Column:
    return round_half_even(safe_divide(c(strike) - c(underlying), underlying), 3)


def iv_front_back_diff(front: Column | str, back: Column | str) -> Column:
    """Relative front/back volatility difference with its zero rules.

    A zero front gives 0 against a zero back and 1 against anything else,
    a missing back included.
    """
    f, b = c(front), c(back)
    return (
        F.when((f == 0) & F.coalesce(b == 0, F.lit(False)), F.lit(0.0))
        .when(f == 0, F.lit(1.0))
        .otherwise(safe_divide(f - b, f))
        .cast("float")
    )


def calendar_metrics(
    bid: Column, ask: Column, bid_back: Column, ask_back: Column, underlying: Column
) -> dict[str, Column]:
    """Cost and market of buying the back leg and selling the front leg."""
    front, back = mark(bid, ask), mark(bid_back, ask_back)
    cost = back - front
    ask_cal, bid_cal = ask_back - bid, bid_back - ask
    spread_cal = ask_cal - bid_cal
    return {
        "calCost": cost,
        "calCostPct": safe_divide(cost, underlying) * 100,
        # The index tables carry this difference under the name of a percentage.
        "calGapPct": cost - back,
        "ask_cal": ask_cal,
        "bid_cal": bid_cal,
        "spread_cal": spread_cal,
        "mark_cal": spread_cal / 2 + bid_cal,
        "spreadPct_cal": safe_divide(spread_cal, ask_cal),
    }


def wide_calendar_metrics(df: DataFrame, gaps: int, underlying: str = "underlying") -> DataFrame:
    """Calendar metrics per right and gap; raw bid/ask prices are dropped.

    Front columns are ``bid_C``; the back leg of gap *g* is ``bid_C_G<g>``.
    """
    metrics: dict[str, Column] = {}
    for r in RIGHTS:
        metrics[f"mark_{r}"] = mark(f"bid_{r}", f"ask_{r}")
        for g in range(1, gaps + 1):
            sfx = f"{r}_G{g}"
            metrics[f"mark_{sfx}"] = mark(f"bid_{sfx}", f"ask_{sfx}")
            pair = calendar_metrics(
                c(f"bid_{r}"), c(f"ask_{r}"), c(f"bid_{sfx}"), c(f"ask_{sfx}"), c(underlying)
            )
            metrics.update({f"{name}_{sfx}": col for name, col in pair.items()})
    kept = columns_without(df, ("bid_P", "ask_P", "bid_C", "ask_C"))
    return df.select(*kept, *[col.alias(name) for name, col in metrics.items()])


def equity_calendar_metrics(df: DataFrame) -> DataFrame:
    """Calendar metrics of a ``_front``/``_back`` pair table.

    ``calGapPct`` here is the share of the back mark that the calendar costs;
    the alert thresholds (0.1 to 0.475) only make sense for that ratio.
    """
    pair = calendar_metrics(c("bid_front"), c("ask_front"), c("bid_back"), c("ask_back"), c("underlying"))
    back = mark("bid_back", "ask_back")
    pair["calGapPct"] = safe_divide(pair["calCost"], back)
    return df.withColumns(
        {"mark_front": mark("bid_front", "ask_front"), "mark_back": back, **pair}
    )


def wide_iv_diff(df: DataFrame, gaps: int) -> DataFrame:
    """``iv_pct_diff_<r>_G<g>`` for both rights and every gap."""
    return df.withColumns(
        {
            f"iv_pct_diff_{r}_G{g}": iv_front_back_diff(f"implied_vol_{r}", f"implied_vol_{r}_G{g}")
            for r in RIGHTS
            for g in range(1, gaps + 1)
        }
    )


def columns_without(df: DataFrame, fragments: Iterable[str]) -> list[str]:
    """Column names that contain none of the fragments."""
    fragments = tuple(fragments)
    return [name for name in df.columns if not any(f in name for f in fragments)]


def midpoint_ms(a: Column | str, b: Column | str) -> Column:
    """Integer midpoint of two times of day."""
    return ((c(a).cast("long") + c(b).cast("long")) / 2).cast("int")


def expected_price(df: DataFrame) -> DataFrame:
    """Columns that compare today's cost with its backtest history.

    Needs calCost, calCostPct, calCostPctMean, calCostPctMeanDayZero, underlying.
    """
    avg_cost = c("calCostPctMean") / 100 * c("underlying")
    expected = c("calCostPctMeanDayZero") / 100 * c("underlying")
    profit = expected - c("calCost")
    return df.withColumns(
        {
            "avgCalCost": avg_cost,
            "pct_under_over_mean": safe_divide(c("calCostPct") - c("calCostPctMean"), "calCostPctMean"),
            "expectedCalCostPctDiff": c("calCostPctMeanDayZero") - c("calCostPctMean"),
            "expectedCalCost": expected,
            "targetPrice": F.greatest(expected, c("calCost")),
            "expectedProfit": profit,
            "expectedProfitPct": safe_divide(profit, "calCost"),
        }
    )
