"""Row filters on option tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.functions.numeric import c
from legweave.scratch import settle
from legweave.skew import attach_aggregates, salted_join, top_k

# Fixed values of the near-the-money ladder: the band, and how much each rung
# widens it on either side.
BAND_LOW, BAND_HIGH = -0.003, 0.05
RUNG_DOWN, RUNG_UP = -0.00025, 0.003

# How far a strike may lie outside the traded range.
CORRIDOR_LOW, CORRIDOR_HIGH = 0.94, 1.06

MIN_RESULT_DATES = 5


def ladder_rungs() -> list[tuple[float, float]]:
    """Bounds of the rungs, from the narrowest, while they stay in the band."""
    rungs = []
    i = 0
    while round(RUNG_UP * i, 6) <= BAND_HIGH:
        rungs.append((round(RUNG_DOWN * i, 6), round(RUNG_UP * i, 6)))
        i += 1
    return rungs


def first_rung(x: Column) -> Column:
    """Index of the narrowest rung that contains ``x``; null when none does."""
    rungs = ladder_rungs()
    low, high = rungs[0]
    pick = F.when((x >= low) & (x <= high), 0)
    for i, (low, high) in enumerate(rungs[1:], start=1):
        pick = pick.when((x >= low) & (x <= high), i)
    return pick


def near_the_money(
    df: DataFrame,
    keys: Sequence[str],
    max_rows: int = 2,
    moneyness: str = "undPricePctDiff",
    order: Sequence[str] = ("strike_milli",),
) -> DataFrame:
    """At most ``max_rows`` rows per group, from the narrowest rung that has enough.

    A group with more than ``max_rows`` rows in the band is cut to the first rung
    holding at least that many (to the band if none does), and then to its first
    ``max_rows`` rows in ``order``.

    Both steps work on trimmed groups: inside a rung only the first ``max_rows``
    rows can ever be kept, and capping a rung's count there does not change which
    rung is the first to reach ``max_rows``.  So each group shrinks to a few rows
    per rung map-side, however many rows it holds.
    """
    keys = list(keys)
    x = F.col(moneyness)
    in_band = df.filter((x >= BAND_LOW) & (x <= BAND_HIGH)).withColumn("__rung", first_rung(x))
    trimmed = top_k(in_band, [*keys, "__rung"], [F.asc(o) for o in order], max_rows)
    by_rung = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("__rung"), *order)
    everything = Window.partitionBy(*keys)
    placed = trimmed.withColumn("__place", F.row_number().over(by_rung)).withColumn(
        "__limit", F.max(F.when(F.col("__place") == max_rows, F.col("__rung"))).over(everything)
    )
    kept = placed.filter(F.col("__limit").isNull() | (F.col("__rung") <= F.col("__limit")))
    return top_k(kept, keys, [F.asc(o) for o in order], max_rows).drop("__rung", "__place", "__limit")


def open_interest_above(df: DataFrame, min_oi: int) -> DataFrame:
    """Both legs above ``min_oi``; off when it is 0."""
    if min_oi <= 0:
        return df
    return df.filter((F.col("open_interest_front") > min_oi) & (F.col("open_interest_back") > min_oi))


def nonzero_underlying(df: DataFrame, underlying: str = "underlying") -> DataFrame:
    return df.filter(F.col(underlying) != 0)


def upper_median(sorted_array: Column | str) -> Column:
    """Middle item of a sorted array, the later one when the size is even."""
    a = c(sorted_array)
    return F.get(a, F.floor(F.size(a) / 2).cast("int"))


def strike_corridor(
    plans: DataFrame, greeks: DataFrame, plan_keys: Sequence[str], right: str, roots: DataFrame | None = None
) -> DataFrame:
    """Limits the ``strikes`` of each plan to the traded range of its underlying.

    The range is taken from non-zero underlyings of the front expiration at the
    upper-median strike, between the plan's first and last trade date.  Plans
    left without a price or a strike are dropped.  Plans need ``symbol``,
    ``exp_front``, ``trade_dates`` and ``strikes``.  With ``roots`` the greeks
    are read under every name of a symbol.
    """
    plan_keys = list(plan_keys)
    contract = ["symbol", "exp", "strike_milli"]
    probe = plans.select(
        *dict.fromkeys([*plan_keys, "symbol"]),
        F.col("exp_front").alias("exp"),
        upper_median("strikes").alias("strike_milli"),
        F.array_min("trade_dates").alias("__from"),
        F.array_max("trade_dates").alias("__to"),
    )
    # Only the probed contracts of the plans' days are aggregated.
    probed = greeks.filter(F.col("opt_right") == right).select(*contract, "trade_date", "underlying")
    if roots is not None:
        # The few probes take the names, so the greeks are dealt once.
        probe, probed = probe.join(roots, "symbol"), probed.withColumnRenamed("symbol", "root")
        contract = ["root", "exp", "strike_milli"]
    und_range = (
        nonzero_underlying(probed)
        .join(probe, contract)
        .filter(F.col("trade_date").between(F.col("__from"), F.col("__to")))
        .groupBy(*plan_keys)
        .agg(F.min("underlying").alias("min_und"), F.max("underlying").alias("max_und"))
    )
    low, high = F.col("min_und") * CORRIDOR_LOW, F.col("max_und") * CORRIDOR_HIGH
    return (
        plans.join(und_range, plan_keys)
        .withColumn("strikes", F.filter("strikes", lambda s: (s / 1000 > low) & (s / 1000 < high)))
        .filter(F.size("strikes") > 0)
    )


def enough_dates(df: DataFrame, keys: Sequence[str], min_dates: int = MIN_RESULT_DATES) -> DataFrame:
    """Rows of those groups with more than ``min_dates`` distinct trade dates.

    The result is written once and gated by itself, so what made it runs once.
    """
    df = settle(df, "dated")
    gate = (
        df.select(*keys, "trade_date")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("__dates"))
        .filter(F.col("__dates") > min_dates)
        .drop("__dates")
    )
    return salted_join(df, gate, keys, "left_semi")


def drop_edge_bars(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops the first and the last bar of each slice."""
    # A slice is one expiration on one day, bounded by the exchange.
    edges = attach_aggregates(df, keys, {"__first": F.min("ms_of_day"), "__last": F.max("ms_of_day")})
    return edges.filter(
        (F.col("ms_of_day") != F.col("__first")) & (F.col("ms_of_day") != F.col("__last"))
    ).drop("__first", "__last")


def complete_slices(greeks: DataFrame, quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Greeks of slices that hold both rights of every quoted strike.

    A slice is one expiration on one day, so its strikes fit in an array; each
    table is read once.
    """
    keys = list(keys)
    quoted = quotes.groupBy(*keys).agg(F.collect_set("strike_milli").alias("__quoted"))
    slices = Window.partitionBy(*keys)
    held = {f"__{r}": F.collect_set(F.when(F.col("opt_right") == r, F.col("strike_milli"))).over(slices) for r in ("P", "C")}
    lacking = [F.size(F.array_except("__quoted", name)) for name in held]
    return (
        greeks.withColumns(held)
        .join(quoted, keys)
        .filter((lacking[0] == 0) & (lacking[1] == 0))
        .drop("__quoted", *held)
    )
