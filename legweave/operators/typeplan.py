"""Whole-table type inference for tables that arrive as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how a date starts.
DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def _numeric(name: str) -> Column:
    return F.col(name).try_cast("double")


def _all(condition: Column) -> Column:
    """True when the condition holds on every row (null counts as false)."""
    return F.bool_and(F.coalesce(condition, F.lit(False)))


def plan_types(df: DataFrame, skip: Sequence[str] = ()) -> dict[str, str]:
    """The target type of each text or floating column, from one aggregate pass.

    Text: all values integral numbers -> long, all numbers -> double (a missing
    value keeps a column from becoming long), all True/False -> boolean, all
    starting with an ISO date -> timestamp, else text.  Floating columns without
    nulls whose values are integral become long.

    Only the one-row result reaches the driver.
    """
    probes: list[Column] = []
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip]
    for n in text:
        v, num = F.col(n), _numeric(n)
        probes += [
            F.count(v).alias(f"{n}|some"),
            F.bool_and(v.isNull() | num.isNotNull()).alias(f"{n}|num"),
            _all(num == F.floor(num)).alias(f"{n}|int"),
            F.bool_and(v.isNull() | v.isin("True", "False")).alias(f"{n}|bool"),
            _all(v.rlike(DATE_PREFIX) & v.try_cast("timestamp").isNotNull()).alias(f"{n}|date"),
        ]
    for n in floats:
        probes.append(_all(F.col(n) == F.floor(n)).alias(f"{n}|int"))
    if not probes:
        return {}
    found = df.agg(*probes).first().asDict()
    plan: dict[str, str] = {}
    for n in text:
        if not found[f"{n}|some"]:
            plan[n] = "string"
        elif found[f"{n}|num"]:
            plan[n] = "bigint" if found[f"{n}|int"] else "double"
        elif found[f"{n}|bool"]:
            plan[n] = "boolean"
        elif found[f"{n}|date"]:
            plan[n] = "timestamp"
        else:
            plan[n] = "string"
    for n in floats:
        if found[f"{n}|int"]:
            plan[n] = "bigint"
    return plan


def apply_types(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Cast by plan in one projection.  Integral text may read '12.0'."""
    def cast(name: str) -> Column:
        target = plan.get(name)
        col = F.col(name)
        if target is None or target == "string":
            return col
        if target == "bigint" and isinstance(df.schema[name].dataType, T.StringType):
            exact = col.try_cast("bigint")
            return F.coalesce(exact, col.try_cast("double").cast("bigint")).alias(name)
        return col.cast(target).alias(name)

    return df.select(*[cast(n) for n in df.columns])


def infer_types(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    return apply_types(df, plan_types(df, skip))
