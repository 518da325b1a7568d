"""Joins and aggregates that survive one key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT, SALTS = "__salt", "__salts"


def hot_keys(landed: DataFrame, on: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Keys that hold more than one partition's share of a landed table, and how many partitions they fill.

    With P shuffle partitions fewer than P keys can hold more than 1/P of the
    rows each, so the result has fewer than P rows however large the table is.
    """
    partitions = partitions or int(landed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = landed.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    whole = landed.agg(F.count(F.lit(1)).alias("__all"))  # one row
    share = F.col("__rows") * partitions / F.col("__all")
    return (
        counts.crossJoin(F.broadcast(whole)).filter(share > 1).select(*on, F.ceil(share).cast("int").alias(SALTS))
    )


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join whose hot keys are spread over as many partitions as they fill.

    ``hot`` is a table of :func:`hot_keys`, measured on the landed rows behind
    ``facts``.  Rows of a hot key pick one of its salts by a hash of their other
    columns, so a recomputed task repeats the choice, and only ``dim`` rows of
    hot keys are repeated, once per salt.  Facts without another column to
    spread by can't be salted, which is an error.  Without ``hot`` it is a plain
    join, whose skewed partitions Spark splits at run time where both sides are
    shuffled for it.

    ``how`` may be inner, left, left_semi or left_anti (``facts`` on the left).
    """
    on = list(on)
    if hot is None:
        return facts.join(dim, on, how)
    spread = list(spread_by) if spread_by else [
        f.name for f in facts.schema.fields if f.name not in on and not _nested(f.dataType)
    ]
    if not spread:
        raise ValueError(f"no column to spread hot keys of {on} by")
    # Fewer rows than shuffle partitions, see hot_keys.
    hot = F.broadcast(hot.select(*on, SALTS))
    salts = F.coalesce(F.col(SALTS), F.lit(1))
    salted = facts.join(hot, on, "left").withColumn(SALT, F.pmod(F.xxhash64(*spread), salts).cast("int")).drop(SALTS)
    repeated = dim.join(hot, on, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1))).drop(SALTS)
    return salted.join(repeated, [*on, SALT], how).drop(SALT)


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.MapType, T.ArrayType, T.StructType))


def attach_aggregates(rows: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Group totals on every row; ``rows`` is read once.

    The totals are unordered windows, so a group must fit in a task: use it for
    keys whose groups the domain bounds, as a slice of one day.
    """
    w = Window.partitionBy(*keys)
    return rows.withColumns({name: agg.over(w) for name, agg in aggs.items()})


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group under a total order.

    Written as ``row_number() <= k`` so Spark trims every group to ``k`` rows
    per map task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")
