"""Volatility term structure at the strike nearest the money, and its peak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.functions.dates import days_between
from legweave.functions.numeric import round_half_even
from legweave.functions.pricing import strike_pct_from_underlying, strike_price
from legweave.skew import salted_join

DAY_KEYS = ["symbol", "trade_date"]
CHAIN_KEYS = [*DAY_KEYS, "opt_right"]

# Fixed value: expirations further than this many days from the trade date are not part of the chain.
HORIZON_DAYS = 90

# Fixed value: fewer modal strikes than this are worth a warning.
FEW_STRIKES = 3


def mean_underlying(greeks: DataFrame) -> DataFrame:
    return greeks.groupBy(*DAY_KEYS).agg(round_half_even(F.avg("underlying"), 2).alias("underlying"))


def in_horizon(greeks: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """Expirations up to ``days`` days from their trade date."""
    return greeks.filter(days_between("trade_date", "exp").between(0, days))


def modal_strikes(greeks: DataFrame) -> DataFrame:
    """Strikes listed in the most expirations, per symbol, day and right (ties stay)."""
    per_strike = (
        greeks.select(*CHAIN_KEYS, "strike_milli", "exp")
        .distinct()
        .groupBy(*CHAIN_KEYS, "strike_milli")
        .agg(F.count("*").alias("n_exp"))
    )
    most = F.max("n_exp").over(Window.partitionBy(*CHAIN_KEYS))
    return per_strike.withColumn("__most", most).filter(F.col("n_exp") == F.col("__most")).drop("__most")


def few_modal_strikes(strikes: DataFrame) -> DataFrame:
    """Symbols, days and rights with too few modal strikes."""
    return strikes.groupBy(*CHAIN_KEYS).agg(F.count("*").alias("n")).filter(F.col("n") < FEW_STRIKES)


def nearest_strike(strikes: DataFrame, underlying: DataFrame) -> DataFrame:
    """The modal strike nearest the underlying; the lower one on a tie."""
    gap = F.abs(F.col("strike_milli") - F.col("underlying") * 1000)
    return (
        salted_join(strikes, underlying, DAY_KEYS)
        .groupBy(*CHAIN_KEYS)
        .agg(
            F.min_by("strike_milli", F.struct(gap.alias("gap"), "strike_milli")).alias("strike_milli"),
            F.max("underlying").alias("underlying"),
        )
    )


def volatility_chain(greeks: DataFrame) -> DataFrame:
    """Greeks of every expiration within the horizon at the nearest modal strike of each day and right."""
    greeks = in_horizon(greeks)
    chosen = nearest_strike(modal_strikes(greeks), mean_underlying(greeks))
    rows = salted_join(greeks.drop("underlying"), chosen, [*CHAIN_KEYS, "strike_milli"])
    with_strike = rows.withColumn("strike", strike_price("strike_milli"))
    return with_strike.withColumn("strike_pct_diff", strike_pct_from_underlying("strike", "underlying"))


def peak_expirations(chain: DataFrame) -> DataFrame:
    """Expiration of the highest volatility per symbol, day and right.

    Missing volatilities never win; the later expiration wins a tie.
    """
    return (
        chain.filter(F.col("implied_vol").isNotNull() & ~F.isnan("implied_vol"))
        .groupBy(*CHAIN_KEYS)
        .agg(F.max_by("exp", F.struct("implied_vol", "exp")).alias("exp"))
    )


def peaks_by_right(peaks: DataFrame) -> DataFrame:
    """One row per symbol and day: peak of calls and puts, and whether they agree."""
    wide = peaks.groupBy(*DAY_KEYS).agg(
        F.max(F.when(F.col("opt_right") == "C", F.col("exp"))).alias("iv_max_exp_c"),
        F.max(F.when(F.col("opt_right") == "P", F.col("exp"))).alias("iv_max_exp_p"),
    )
    return wide.withColumn("iv_pc_max_same", _same("iv_max_exp_c", "iv_max_exp_p"))


def with_iv_flags(df: DataFrame, peaks: DataFrame) -> DataFrame:
    """Joins the peaks and flags those that fall on the front expiration."""
    on_front = {r: _same(f"iv_max_exp_{r}", "exp_front") for r in ("c", "p")}
    return salted_join(df, peaks, DAY_KEYS).withColumns(
        {
            "iv_fexp_c": on_front["c"],
            "iv_fexp_p": on_front["p"],
            "iv_consensus": on_front["c"] & on_front["p"],
        }
    )


def _same(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) == F.col(b), F.lit(False))
