"""Choosing which scored calendars become alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.labels import gap_limit
from legweave.functions.numeric import round_half_even
from legweave.skew import salted_join, top_k

# Fixed value: seconds that must have passed since the last alert of a key.
COOLDOWN_SECONDS = 3600

ALERT_KEYS = ["symbol", "weeks"]

# Digits of the rounded column groups.
ROUNDED = {
    3: ["implied_vol_back", "implied_vol_front", "iv_pct_diff", "calCost", "avgCalCost", "calGapPct", "pct_under_over_mean"],
    2: ["spreadPct_front", "spreadPct_back", "spreadPct_cal"],
}


@dataclass(frozen=True)
class AlertPreset:
    """Thresholds of an alert (fixed values)."""

    min_history: int = 7
    min_bdte: int = 5
    max_bdte: int = 12
    pct_under_over_mean: float = 0.0
    min_size: int = 10
    max_leg_spread: float = 0.3
    max_cal_spread: float = 0.6
    min_cost: float = 0.5
    max_cost: float = 10.0


def latest_version(df: DataFrame, version: str = "lastUpdated") -> DataFrame:
    """Rows of the newest version only (a one-row aggregate joined back)."""
    newest = df.agg(F.max(version).alias(version))
    return df.join(F.broadcast(newest), version, "left_semi")


def rounded(df: DataFrame) -> DataFrame:
    """The alert's column groups at their digits; absent columns are skipped."""
    cols = {n: round_half_even(n, digits) for digits, names in ROUNDED.items() for n in names if n in df.columns}
    return df.withColumns(cols)


def passes_preset(df: DataFrame, preset: AlertPreset = AlertPreset()) -> DataFrame:
    c = F.col
    sizes = ("ask_size_back", "bid_size_back", "ask_size_front", "bid_size_front")
    keep = (
        (c("histEarningsCount") >= preset.min_history)
        & c("bdte").between(preset.min_bdte, preset.max_bdte)
        & (c("pct_under_over_mean") < preset.pct_under_over_mean)
        & (c("spreadPct_front") <= preset.max_leg_spread)
        & (c("spreadPct_back") <= preset.max_leg_spread)
        & (c("spreadPct_cal") <= preset.max_cal_spread)
        & (c("calCost") > preset.min_cost)
        & (c("calCost") < preset.max_cost)
    )
    for s in sizes:
        keep = keep & (c(s) >= preset.min_size)
    return df.filter(keep)


def gap_below_limit(df: DataFrame) -> DataFrame:
    return df.filter(F.col("calGapPct") < gap_limit("weeks"))


def best_per_key(df: DataFrame, tie_breakers: Sequence[str]) -> DataFrame:
    """The row nearest the money per symbol and weeks."""
    return top_k(df, ALERT_KEYS, [F.asc("undPricePctDiff"), *[F.asc(t) for t in tie_breakers]], 1)


def past_cooldown(alerts: DataFrame, log: DataFrame, seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """Alerts of one run whose key has no alert on their day, or none within ``seconds``.

    Both sides carry ``alert_date``.  The log is reduced to one time per key and
    day before the join.
    """
    keys = [*ALERT_KEYS, "alert_date"]
    last = log.groupBy(*keys).agg(F.max("alert_time").alias("__last"))
    joined = salted_join(alerts, last, keys, "left")
    return joined.filter(
        F.col("__last").isNull() | (F.col("alert_time") - F.col("__last") > seconds)
    ).drop("__last")


def not_muted(alerts: DataFrame, muted: DataFrame, today: int) -> DataFrame:
    """Drops (chat, symbol) pairs whose mute ends after ``today``."""
    active = muted.filter(F.col("mute_end") > today).select("chat_id", F.col("ticker").alias("symbol")).distinct()
    return salted_join(alerts, active, ["chat_id", "symbol"], "left_anti")


def for_chats(alerts: DataFrame, chat_ids: Sequence[str]) -> DataFrame:
    """One row per alert and chat."""
    return alerts.withColumn("chat_id", F.explode(F.array(*[F.lit(i) for i in chat_ids])))


def in_alert_order(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(*ALERT_KEYS)
