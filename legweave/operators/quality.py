"""Checks whose result is a table of violations or one row of totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.numeric import round_half_even

# Fixed value: largest relative distance of one price from the mean price.
MAX_PRICE_DEVIATION = 0.0005


def varying_within(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups in which a column that should be constant takes several values."""
    spread = [F.min(c) != F.max(c) for c in columns]
    bad = spread[0]
    for s in spread[1:]:
        bad = bad | s
    return df.groupBy(*keys).agg(bad.alias("__bad")).filter("__bad").drop("__bad")


def require_none(violations: DataFrame, message: str) -> None:
    """Raise when the violation table is not empty."""
    sample = violations.limit(5).collect()
    if sample:
        raise ValueError(f"{message}: {[r.asDict() for r in sample]}")


def price_per_expiration(greeks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One underlying price per expiration, taken at its lowest strike."""
    return greeks.groupBy(*keys, "exp").agg(
        F.min_by("underlying", F.struct("strike_milli", "opt_right", "underlying")).alias("price")
    )


def underlying_consensus(greeks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean price over expirations (two digits), worst deviation, and the verdict."""
    return (
        price_per_expiration(greeks, keys)
        .groupBy(*keys)
        .agg(
            round_half_even(F.avg("price"), 2).alias("mean_price"),
            F.min("price").alias("__low"),
            F.max("price").alias("__high"),
        )
        .withColumn(
            "deviation",
            F.try_divide(
                F.greatest(F.abs(F.col("mean_price") - F.col("__low")), F.abs(F.col("mean_price") - F.col("__high"))),
                F.col("mean_price"),
            ),
        )
        .withColumn("agrees", F.coalesce(F.col("deviation") <= MAX_PRICE_DEVIATION, F.lit(False)))
        .drop("__low", "__high")
    )


def duplicate_keys(df: DataFrame, within: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per ``within`` group, the largest number of rows sharing ``keys``, if above 1."""
    return (
        df.groupBy(*within, *keys)
        .agg(F.count("*").alias("__n"))
        .groupBy(*within)
        .agg(F.max("__n").alias("max_count"))
        .filter(F.col("max_count") > 1)
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
