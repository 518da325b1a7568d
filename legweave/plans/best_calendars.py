"""The best near-the-money calendars of every symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.pricing import calendar_metrics, strike_price
from legweave.operators.filters import near_the_money
from legweave.operators.legs import front_back_pairs
from legweave.skew import top_k

MAX_SPAN_DAYS = 10


def best_calendars(chain: DataFrame, max_rows: int = 2) -> DataFrame:
    """Near-the-money pairs, and of those the cheapest per symbol and right.

    ``chain`` holds bid, ask, underlying and implied_vol per contract and date.
    """
    keys = ["symbol", "opt_right", "strike_milli", "trade_date"]
    legs = chain.select(*keys, "exp", "bid", "ask", "underlying", "implied_vol")
    strike = F.col("strike_milli") / 1000
    near = near_the_money(
        front_back_pairs(legs, keys, MAX_SPAN_DAYS).withColumn(
            "undPricePctDiff", F.try_divide(strike - F.col("underlying_front"), F.col("underlying_front"))
        ),
        ["symbol", "opt_right", "trade_date", "exp_front", "exp_back"],
        max_rows,
    )
    metrics = calendar_metrics(
        F.col("bid_front"), F.col("ask_front"), F.col("bid_back"), F.col("ask_back"), F.col("underlying_front")
    )
    priced = near.select(
        "symbol",
        "opt_right",
        "trade_date",
        "exp_front",
        "exp_back",
        "strike_milli",
        strike_price("strike_milli").alias("strike"),
        "undPricePctDiff",
        *[col.alias(n) for n, col in metrics.items()],
    )
    order = [F.asc("calCost"), F.asc("trade_date"), F.asc("exp_front"), F.asc("exp_back"), F.asc("strike_milli")]
    return top_k(priced, ["symbol", "opt_right"], order, 1)
