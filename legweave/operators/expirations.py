"""Listings per symbol and expiration, and the choice of expirations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.functions.dates import days_between, to_day, to_yyyymmdd
from legweave.functions.numeric import c
from legweave.skew import salted_join, top_k

# Days added to the ideal back expiration, in order of preference.
BACK_DAY_OFFSETS = (0, 1, -1, 2, -2, 3, -3)
VALID_WEEKS = (1, 2, 3, 4, 5, 6)

FRONT_LIMIT_DAYS = 7


def sorted_set(col: Column | str) -> Column:
    """Distinct values of a group as a sorted array.

    ``collect_set`` removes repeats map-side; use it where the number of
    *distinct* values is limited by the exchange (dates, strikes, expirations).
    """
    return F.array_sort(F.collect_set(c(col)))


def expirations_of(quotes: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return quotes.select(*keys, "exp").distinct()


def trading_days_of(quotes: DataFrame) -> DataFrame:
    """Per expiration its sorted trading days."""
    return quotes.groupBy("symbol", "exp").agg(sorted_set("trade_date").alias("trade_dates"))


def strikes_of(quotes: DataFrame) -> DataFrame:
    """Per expiration its sorted strikes."""
    return quotes.groupBy("symbol", "exp").agg(sorted_set("strike_milli").alias("strikes"))


def contract_listing(quotes: DataFrame) -> DataFrame:
    """Trading days and strikes of each expiration in one pass.

    Repeats go by hashing first: sets alone are collected by sorting every row.
    """
    day, strike = F.col("trade_date"), F.col("strike_milli")
    none = [F.lit(None).alias(n) for n in ("trade_date", "strike_milli")]
    items = F.explode(F.array(F.struct(day, none[1]), F.struct(none[0], strike)))
    seen = quotes.select("symbol", "exp", items.alias("item")).select("symbol", "exp", "item.*").distinct()
    # Lists, as Spark drops a distinct that only feeds sets.
    return seen.groupBy("symbol", "exp").agg(
        F.array_sort(F.collect_list("trade_date")).alias("trade_dates"),
        F.array_sort(F.collect_list("strike_milli")).alias("strikes"),
    )


def listing_of_roots(listing: DataFrame, roots: DataFrame) -> DataFrame:
    """A :func:`contract_listing` by the names of the market tables as one by their symbols."""
    named = salted_join(listing.withColumnRenamed("symbol", "root"), roots, ["root"])
    return named.groupBy("symbol", "exp").agg(
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(n)))).alias(n) for n in ("trade_dates", "strikes")]
    )


def expiration_lists(quotes: DataFrame) -> DataFrame:
    """Per symbol its sorted expirations."""
    return quotes.groupBy("symbol").agg(sorted_set("exp").alias("expirations"))


def expiration_pairs(quotes: DataFrame) -> DataFrame:
    """Every (symbol, exp_front, exp_back) of two listed expirations, the front one earlier."""
    later = F.explode(F.filter("expirations", lambda e: e > F.col("exp_front")))
    fronts = expiration_lists(quotes).select("symbol", "expirations", F.explode("expirations").alias("exp_front"))
    return fronts.select("symbol", "exp_front", later.alias("exp_back"))


def first_expiration_from(expirations: Column | str, day: Column | str) -> Column:
    """Smallest expiration on or after ``day``."""
    return F.array_min(F.filter(c(expirations), lambda e: e >= c(day)))


def back_expiration(expirations: Column | str, front: Column | str, weeks: Column | str, day: Column | str) -> Column:
    """The back expiration ``weeks`` after the front, or null.

    The listed date nearest to front + 7 * weeks wins, in the fixed order of
    preference; only expirations on or after ``day`` count.
    """
    w = c(weeks).cast("int")
    ideal = F.date_add(to_day(front), w * 7)
    listed = F.filter(c(expirations), lambda e: e >= c(day))
    tries = F.array(*[to_yyyymmdd(F.date_add(ideal, off)) for off in BACK_DAY_OFFSETS])
    hits = F.filter(tries, lambda t: F.array_contains(listed, t))
    return F.when(
        ~w.isin(*VALID_WEEKS), F.raise_error(F.lit("weeks must be 1 to 6")).cast("int")
    ).otherwise(F.get(hits, F.lit(0)))


def choose_expirations(plan: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds ``exp_front`` and ``exp_back`` to rows of (symbol, report_date, weeks).

    Rows without a back expiration, or whose front expires a week or more after
    the report, are dropped.  The expirations of a symbol travel as one array,
    so no row is repeated per candidate date.
    """
    return (
        salted_join(plan, lists, ["symbol"])
        .withColumn("exp_front", first_expiration_from("expirations", "report_date"))
        .withColumn("exp_back", back_expiration("expirations", "exp_front", "weeks", "report_date"))
        .drop("expirations")
        .filter(F.col("exp_front").isNotNull() & F.col("exp_back").isNotNull())
        .filter(front_near_report("report_date", "exp_front"))
    )


def front_near_report(report_date: Column | str, exp_front: Column | str) -> Column:
    return days_between(report_date, exp_front) < FRONT_LIMIT_DAYS


def common_listing(plan: DataFrame, listing: DataFrame, min_dates: int) -> DataFrame:
    """Adds the trading days and strikes shared by both legs.

    Plans with fewer than ``min_dates`` shared days are dropped.
    """
    for leg in ("front", "back"):
        side = listing.select(
            "symbol",
            F.col("exp").alias(f"exp_{leg}"),
            F.col("trade_dates").alias(f"__dates_{leg}"),
            F.col("strikes").alias(f"__strikes_{leg}"),
        )
        plan = salted_join(plan, side, ["symbol", f"exp_{leg}"])
    return (
        plan.withColumns(
            {
                "trade_dates": F.array_intersect("__dates_front", "__dates_back"),
                "strikes": F.array_intersect("__strikes_front", "__strikes_back"),
            }
        )
        .drop("__dates_front", "__dates_back", "__strikes_front", "__strikes_back")
        .filter(F.size("trade_dates") >= min_dates)
    )


def in_all_groups(df: DataFrame, keys: Sequence[str], item: str, member: str, n: Column | int) -> DataFrame:
    """Items of each key that occur in all ``n`` members (an n-way intersection)."""
    return (
        df.select(*keys, item, member)
        .distinct()
        .groupBy(*keys, item)
        .agg(F.count("*").alias("__n"))
        .filter(F.col("__n") == n)
        .drop("__n")
    )


def last_trading_days(days: DataFrame, n: int) -> DataFrame:
    """The last ``n`` trade dates of each (symbol, exp)."""
    return top_k(days, ["symbol", "exp"], [F.desc("trade_date")], n)


def expires_on_trading_day(days: DataFrame) -> DataFrame:
    """Rows of those expirations that are among their own trading days."""
    own = days.filter(F.col("exp") == F.col("trade_date")).select("symbol", "exp").distinct()
    return days.join(own, ["symbol", "exp"], "left_semi")


def expiration_runs(days: DataFrame, length: int) -> DataFrame:
    """Distinct runs of ``length`` consecutive active expirations.

    On each trade date the active expirations are sorted and a frame of
    ``length`` rows slides over them.  A window holds the expirations listed on
    one day, not quotes.
    """
    frame = Window.partitionBy("symbol", "trade_date").orderBy("exp").rowsBetween(0, length - 1)
    return (
        days.select("symbol", "trade_date", "exp")
        .distinct()
        .select("symbol", F.collect_list("exp").over(frame).alias("exps"))
        .filter(F.size("exps") == length)
        .distinct()
    )


def runs_with_common_days(runs: DataFrame, days: DataFrame, min_dates: int) -> DataFrame:
    """Runs whose expirations share at least ``min_dates`` trade dates.

    Adds ``first_day`` and ``last_day`` of the shared dates.
    """
    legs = runs.withColumn("exp", F.explode("exps"))
    shared = (
        salted_join(days.select("symbol", "exp", "trade_date").distinct(), legs, ["symbol", "exp"])
        .groupBy("symbol", "exps", "trade_date")
        .agg(F.count("*").alias("__n"))
        .filter(F.col("__n") == F.size("exps"))
    )
    return (
        shared.groupBy("symbol", "exps")
        .agg(
            F.count("*").alias("n_dates"),
            F.min("trade_date").alias("first_day"),
            F.max("trade_date").alias("last_day"),
        )
        .filter(F.col("n_dates") >= min_dates)
    )


def within_horizon(df: DataFrame, as_of: int, days: int) -> DataFrame:
    """Expirations from ``as_of`` to ``as_of`` + ``days``, both included."""
    return df.filter(days_between(F.lit(as_of), "exp").between(0, days))


def after_now_within(df: DataFrame, now: str, days: int) -> DataFrame:
    """Expirations (at midnight) from the instant ``now`` to ``now`` + ``days``."""
    start = F.to_timestamp(F.lit(now))
    at = to_day("exp").cast("timestamp")
    return df.filter((at >= start) & (at <= start + F.expr(f"INTERVAL {int(days)} DAYS")))


def within_history(days: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Trade dates strictly inside (first, last) of expirations before ``last``."""
    return days.filter(
        (F.col("trade_date") > first_day) & (F.col("trade_date") < last_day) & (F.col("exp") < last_day)
    )
