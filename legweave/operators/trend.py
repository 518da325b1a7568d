"""Price trends by days to the report, and the three-day slice ahead of a trade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.numeric import greatest_strict, least_strict

TREND_KEYS = ["symbol", "weeks", "bdte"]

# The measures of a trend row, in the order of the feature list.
TREND_MEASURES = [
    "stddev",
    "max",
    "min",
    "avg",
    "count",
    "min_entry_size_mean",
    "max_entry_size_mean",
    "min_exit_size_mean",
    "max_exit_size_mean",
    "upper_ci",
    "lower_ci",
]

# A trend row counts from five observations; a slice has three rows.
MIN_TREND_COUNT = 4
SLICE_ROWS = 3


def with_trade_sizes(df: DataFrame) -> DataFrame:
    """Smallest and largest size available to enter and to leave the calendar."""
    return df.withColumns(
        {
            "min_entry_size": least_strict("ask_size_front", "bid_size_back"),
            "max_entry_size": greatest_strict("ask_size_front", "bid_size_back"),
            "min_exit_size": least_strict("ask_size_back", "bid_size_front"),
            "max_exit_size": greatest_strict("ask_size_back", "bid_size_front"),
        }
    )


def price_trend(snapshots: DataFrame) -> DataFrame:
    """Statistics of calCostPct and of the sizes per symbol, weeks and bdte."""
    sizes = ["min_entry_size", "max_entry_size", "min_exit_size", "max_exit_size"]
    stats = (
        snapshots.dropna(subset=TREND_KEYS)
        .groupBy(*TREND_KEYS)
        .agg(
            F.stddev_samp("calCostPct").alias("stddev"),
            F.max("calCostPct").alias("max"),
            F.min("calCostPct").alias("min"),
            F.avg("calCostPct").alias("avg"),
            F.count("calCostPct").alias("count"),
            *[F.avg(s).alias(f"{s}_mean") for s in sizes],
        )
    )
    return stats.withColumns(
        {"upper_ci": F.col("avg") + F.col("stddev"), "lower_ci": F.col("avg") - F.col("stddev")}
    )


def trend_slice(trades: DataFrame, trend: DataFrame) -> DataFrame:
    """Three trend rows starting at (or one after) each trade's days to the report.

    Looks at the offsets 0 to 3.  A slice exists when offsets 0-1-2 or 1-2-3 all
    have enough observations; the first three present become ``pre_0_*`` to
    ``pre_2_*``.  Each distinct trade key asks for four exact trend keys, so the
    look-ahead is an equi-join.
    """
    wanted = (
        trades.select(*TREND_KEYS)
        .distinct()
        .withColumn("__off", F.explode(F.array(*[F.lit(i) for i in range(SLICE_ROWS + 1)])))
        .withColumn("__at", F.col("bdte") + F.col("__off"))
    )
    usable = trend.filter(F.col("count") > MIN_TREND_COUNT).select(
        "symbol", "weeks", F.col("bdte").alias("__at"), *TREND_MEASURES
    )
    at = {
        (m, i): f"__{m}_{i}" for m in TREND_MEASURES for i in range(SLICE_ROWS + 1)
    }
    found = (
        wanted.join(usable, ["symbol", "weeks", "__at"])
        .groupBy(*TREND_KEYS)
        .agg(
            *[F.max(F.when(F.col("__off") == i, F.col(m))).alias(name) for (m, i), name in at.items()],
            F.count_if(F.col("__off") == 0).alias("__has_0"),
            F.count_if(F.col("__off") < SLICE_ROWS).alias("__from_0"),
            F.count_if(F.col("__off") > 0).alias("__from_1"),
        )
        .filter((F.col("__from_0") == SLICE_ROWS) | (F.col("__from_1") == SLICE_ROWS))
    )
    slices = [
        F.when(F.col("__has_0") > 0, F.col(at[m, i])).otherwise(F.col(at[m, i + 1])).alias(f"pre_{i}_{m}")
        for i in range(SLICE_ROWS)
        for m in TREND_MEASURES
    ]
    return found.select(*TREND_KEYS, *slices)
