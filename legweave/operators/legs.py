"""Lining up the legs of a calendar: merges, put/call widening, pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.functions.dates import to_day
from legweave.functions.pricing import midpoint_ms

SNAPSHOT_LEG_KEYS = ("symbol", "opt_right", "trade_date", "strike_milli")
HISTORY_LEG_KEYS = (*SNAPSHOT_LEG_KEYS, "ms_of_day")
LEGS = ("front", "back")


def merge(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Equi-join on named keys; other columns present on both sides get a suffix."""
    on = list(on)
    shared = [n for n in left.columns if n in right.columns and n not in on]
    l_names = {n: n + suffixes[0] for n in shared if suffixes[0]}
    r_names = {n: n + suffixes[1] for n in shared if suffixes[1]}
    return left.withColumnsRenamed(l_names).join(right.withColumnsRenamed(r_names), on, how)


def leg_slice(scan: DataFrame, leg: str, exp: Column, kind: str) -> DataFrame:
    """One leg of a scan, without the columns its partner already carries.

    ``kind`` is greeks, quotes or open_interest.
    """
    if leg not in LEGS:
        raise ValueError(f"leg must be one of {LEGS}, not {leg!r}")
    rows = scan.filter(F.col("exp") == exp)
    if leg == "back":
        rows = rows.drop({"greeks": "underlying", "quotes": "ms_of_day"}.get(kind, ""))
    return rows


def leg_scan(scan: DataFrame, pairs: DataFrame, leg: str, kind: str) -> DataFrame:
    """:func:`leg_slice` of many pairs at once: rows of the leg's expiration with the pair they belong to.

    ``pairs`` has symbol, exp_front and exp_back; rows come once per pair.
    """
    if leg not in LEGS:
        raise ValueError(f"leg must be one of {LEGS}, not {leg!r}")
    named = scan.withColumnRenamed("exp", f"exp_{leg}")
    rows = named.join(pairs.select("symbol", "exp_front", "exp_back"), ["symbol", f"exp_{leg}"])
    if leg == "back":
        rows = rows.drop({"greeks": "underlying", "quotes": "ms_of_day"}.get(kind, ""))
    return rows


def join_pair_legs(
    front: DataFrame, back: DataFrame, keys: Sequence[str] = SNAPSHOT_LEG_KEYS, how: str = "inner"
) -> DataFrame:
    """Both legs of every pair on those of ``keys`` that both have."""
    on = [k for k in front.columns if k in keys and k in back.columns]
    return merge(front, back, [*on, "exp_front", "exp_back"], how, ("_front", "_back"))


def join_front_back(front: DataFrame, back: DataFrame, keys: Sequence[str] = SNAPSHOT_LEG_KEYS) -> DataFrame:
    """Front and back leg on those of ``keys`` that the front has."""
    on = [k for k in front.columns if k in keys]
    return merge(front, back, on, "inner", ("_front", "_back"))


def join_quotes_greeks(quotes: DataFrame, greeks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return merge(quotes, greeks, keys, "inner", ("_quote", "_ivgreek"))


def join_open_interest(df: DataFrame, front: DataFrame, back: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Open interest of both legs by left joins.

    Each leg is joined on its own, so a leg without data leaves its own column
    null and the other one intact.  ``keys`` excludes the expiration.
    """
    keys = list(keys)
    for leg, oi in (("front", front), ("back", back)):
        side = oi.select(
            *keys,
            F.col("exp").alias(f"exp_{leg}"),
            F.col("open_interest").alias(f"open_interest_{leg}"),
        )
        df = df.join(side, [*keys, f"exp_{leg}"], "left")
    return df


def earliest_per_day(oi: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Earliest record of the day per key, its time dropped.

    ``min_by`` pre-aggregates, so repeated records shrink before the shuffle.
    """
    values = [n for n in oi.columns if n not in keys and n != "ms_of_day"]
    return oi.groupBy(*keys).agg(*[F.min_by(v, F.struct("ms_of_day", v)).alias(v) for v in values])


def widen_put_call(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put and call rows of a strike side by side as ``_P`` / ``_C`` columns.

    One aggregation replaces the self-join; a strike with only one right is
    dropped, and a right that comes twice under the same keys is an error.
    """
    keys = list(keys)
    values = [n for n in df.columns if n not in keys and n != "opt_right"]
    cells = [
        F.max(F.when(F.col("opt_right") == r, F.col(v))).alias(f"{v}_{r}") for r in ("P", "C") for v in values
    ]
    return _all_present(df.groupBy(*keys).agg(*cells, *_counts("opt_right", ("P", "C"))), ("P", "C"))


def _counts(leg: str, names: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(leg) == n).alias(f"__n_{n}") for n in names]


def _all_present(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows that have every name, by counts ``__n_<name>``; a name that repeats is an error."""
    counts = [F.col(f"__n_{n}") for n in names]
    every = reduce(lambda a, b: a & b, [n > 0 for n in counts])
    repeated = reduce(lambda a, b: a | b, [n > 1 for n in counts])
    said = F.raise_error(F.lit("a leg comes more than once under the same keys")).cast("boolean")
    return wide.filter(F.when(repeated, said).otherwise(every)).drop(*[f"__n_{n}" for n in names])


def join_put_call(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`widen_put_call` for keys that repeat: a join of puts and calls."""
    side = {r: df.filter(F.col("opt_right") == r).drop("opt_right") for r in ("P", "C")}
    return merge(side["P"], side["C"], keys, "inner", ("_P", "_C"))


def fold_legs(legs: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of any number of legs, other columns suffixed by the leg's name.

    A single leg passes through unchanged.
    """
    if len(legs) == 1:
        return next(iter(legs.values()))
    named = [
        df.withColumnsRenamed({n: f"{n}_{leg}" for n in df.columns if n not in keys}) for leg, df in legs.items()
    ]
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), named)


def widen_legs(df: DataFrame, keys: Sequence[str], leg: str, names: Sequence[str], values: Sequence[str]) -> DataFrame:
    """:func:`fold_legs` in one shuffle.

    ``leg`` holds the leg's name; rows with any of ``names`` missing are
    dropped, and a leg that comes twice under the same keys is an error.
    """
    cells = [F.max(F.when(F.col(leg) == n, F.col(v))).alias(f"{v}_{n}") for n in names for v in values]
    return _all_present(df.groupBy(*keys).agg(*cells, *_counts(leg, names)), names)


def calendar_pairs(
    df: DataFrame,
    keys: Sequence[str],
    max_span_days: int,
    suffix: str = "_G1",
    max_front_days: int | None = None,
    from_day: int | None = None,
) -> DataFrame:
    """Every front row with the later expirations of the same strike and time.

    A pair spans at most ``max_span_days`` days, both ends counted.  Optionally
    the front expiration is at most ``max_front_days`` (inclusive) from
    ``from_day``.  The join is an equi-join on ``keys``; the date rule is its
    residual condition, and within a key there is one row per listed expiration.
    """
    keys = list(keys)
    others = [n for n in df.columns if n not in keys]
    # The expiration as a day number once per row, so that the join compares whole numbers.
    numbered = df.withColumn("__day", F.unix_date(to_day("exp")))
    front = numbered
    if max_front_days is not None:
        front = front.filter(F.col("__day") - F.unix_date(to_day(F.lit(from_day))) + 1 <= max_front_days)
    back = numbered.select(
        *[F.col(k).alias(f"__b_{k}") for k in keys], *[F.col(n).alias(n + suffix) for n in others], F.col("__day").alias("__b_day")
    )
    same = [F.col(k) == F.col(f"__b_{k}") for k in keys]
    span = F.col("__b_day") - F.col("__day")
    joined = front.join(back, [*same, span > 0, span + 1 <= max_span_days], "inner")
    joined = joined.drop("__day", "__b_day", *[f"__b_{k}" for k in keys])
    if "ms_of_day" in others:
        joined = joined.withColumn("ms_of_day", midpoint_ms("ms_of_day", f"ms_of_day{suffix}")).drop(
            f"ms_of_day{suffix}"
        )
    return joined


def front_back_pairs(df: DataFrame, keys: Sequence[str], max_span_days: int) -> DataFrame:
    """:func:`calendar_pairs` with every leg column named ``_front`` / ``_back``."""
    pairs = calendar_pairs(df, keys, max_span_days, suffix="_back")
    return pairs.withColumnsRenamed({n: f"{n}_front" for n in df.columns if n not in keys})


def duplicates_agree(groups: dict[str, Sequence[str]]) -> Column:
    """Whether the columns of every group hold the same value in a row; nulls agree with each other."""
    agree = F.lit(True)
    for first, *rest in groups.values():
        for other in rest:
            agree = agree & F.col(first).eqNullSafe(F.col(other))
    return agree


def collapse_duplicates(df: DataFrame, groups: dict[str, Sequence[str]]) -> tuple[DataFrame, Column]:
    """Keep the first column of each group under a new name.

    Also returns an aggregate that is true when the columns of every group agree
    on all rows (for ``observe`` or ``agg``).
    """
    renames = {first: name for name, (first, *_) in groups.items()}
    drops = [other for _, *rest in groups.values() for other in rest]
    return df.drop(*drops).withColumnsRenamed(renames), F.bool_and(duplicates_agree(groups))
