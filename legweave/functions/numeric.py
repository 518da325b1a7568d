"""Numeric helpers with the rounding and division rules of the job outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x: Column | str) -> Column:
    """A column from a name or a column."""
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x: Column | str, digits: int = 0) -> Column:
    """Scale, round half to even on the binary value, scale back.

    This is how array libraries round.  Spark's ``round`` and ``bround`` work on
    the decimal text of the double, and so differ on values such as 1.005.
    """
    factor = F.lit(float(10**digits))
    return F.rint(c(x) * factor) / factor


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """``a / b``, null when ``b`` is 0 (ANSI mode would raise)."""
    return F.try_divide(c(a), c(b))


def finite_or_null(x: Column | str) -> Column:
    """Infinities and NaN become null."""
    v = c(x)
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None)).otherwise(v)


def least_strict(a: Column | str, b: Column | str) -> Column:
    """Minimum of two values; null when either is null."""
    return F.when(c(a).isNotNull() & c(b).isNotNull(), F.least(c(a), c(b)))


def greatest_strict(a: Column | str, b: Column | str) -> Column:
    """Maximum of two values; null when either is null."""
    return F.when(c(a).isNotNull() & c(b).isNotNull(), F.greatest(c(a), c(b)))
