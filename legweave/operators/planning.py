"""Which (symbol, report, weeks) units of work a history run has to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.functions.dates import days_between, quarter_label, to_day
from legweave.functions.numeric import c
from legweave.skew import attach_aggregates, salted_join

# Fixed values of the history run.
SETTLED_DAYS = 14
HISTORY_START = 20160101
MIN_ENTRIES = 2


def symbol_roots(symbols: DataFrame, changes: DataFrame) -> DataFrame:
    """Every (symbol, root): the symbol itself and the names it is listed under."""
    own = symbols.select("symbol", F.col("symbol").alias("root"))
    renamed = changes.join(symbols.select("symbol").distinct(), "symbol", "left_semi").select(
        "symbol", F.col("symbol_changes").alias("root")
    )
    return own.union(renamed).distinct()


def rows_of_roots(df: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of every root of a symbol, stacked; ``symbol`` becomes the owner.

    The row's own name is kept as ``root``.  Nothing is deduplicated.
    """
    return salted_join(df.withColumnRenamed("symbol", "root"), roots, ["root"])


def values_of_roots(df: DataFrame, roots: DataFrame, value: str) -> DataFrame:
    """Per symbol the sorted distinct values over all its roots."""
    return (
        rows_of_roots(df.select("symbol", value).distinct(), roots)
        .groupBy("symbol")
        .agg(F.array_sort(F.collect_set(value)).alias(f"{value}s"))
    )


def several_roots(rows: DataFrame) -> DataFrame:
    """Symbols whose rows come from more than one root."""
    return (
        rows.select("symbol", "root").distinct().groupBy("symbol").agg(F.count("*").alias("n_roots")).filter("n_roots > 1")
    )


def active_symbols(
    entries: DataFrame, date: str = "date", start: int = HISTORY_START, min_entries: int = MIN_ENTRIES
) -> DataFrame:
    """Entries of symbols with enough of them, the last one on or after ``start``.

    The history run applies it to the table of symbol changes.
    """
    return (
        attach_aggregates(
            entries, ["symbol"], {"entries": F.count("*"), "last_entry": F.max(date)}
        )
        .filter((F.col("entries") >= min_entries) & (F.col("last_entry") >= start))
    )


def settled(reports: DataFrame, as_of: int, days: int = SETTLED_DAYS) -> DataFrame:
    """Reports at least ``days`` old."""
    return reports.filter(days_between("report_date", F.lit(as_of)) >= days)


def for_weeks(plan: DataFrame, weeks: Sequence[int]) -> DataFrame:
    """One row per plan row and number of weeks."""
    return plan.withColumn("weeks", F.explode(F.array(*[F.lit(w) for w in weeks])))


def dataset_key(right: str) -> Column:
    """Path of the dataset of one (symbol, weeks, fiscal quarter)."""
    return F.concat(
        F.lit(f"calendar_{right}_"),
        c("weeks").cast("string"),
        F.lit("_weeks/"),
        c("symbol"),
        F.lit("/"),
        c("symbol"),
        F.lit("_"),
        c("fQuarter"),
    )


def expirations_key(symbol: Column | str, exps: Column | str) -> Column:
    """Key of a run of expirations: symbol and all dates joined by ``_``."""
    return F.concat_ws("_", c(symbol), F.transform(c(exps), lambda e: e.cast("string")))


def with_quarters(plan: DataFrame) -> DataFrame:
    return plan.withColumns(
        {
            "fQuarter": quarter_label(to_day("fiscalQuarterEnding")),
            "rQuarter": quarter_label(to_day("report_date")),
        }
    )


def not_in(plan: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plan rows whose keys are not in ``done`` (existing outputs or failures)."""
    return plan.join(done.select(*keys), list(keys), "left_anti")


def due_slices(
    days: DataFrame, existing: DataFrame, datasets: Sequence[str], keys: Sequence[str] = ("symbol", "exp", "trade_date")
) -> DataFrame:
    """(keys, dataset) units that do not exist yet, over all datasets of a day."""
    wanted = days.select(*keys).distinct().withColumn(
        "dataset", F.explode(F.array(*[F.lit(d) for d in datasets]))
    )
    return wanted.join(existing.select(*keys, "dataset"), [*keys, "dataset"], "left_anti")


def mean_grade(grades: DataFrame, grade: str) -> DataFrame:
    return grades.groupBy("symbol").agg(F.avg(grade).alias("mean_grade"))


def by_priority(symbols: DataFrame, grades: DataFrame, grade: str) -> DataFrame:
    """Symbols by mean grade, best first; ungraded ones last in symbol order."""
    return symbols.join(mean_grade(grades, grade), "symbol", "left").orderBy(
        F.desc_nulls_last("mean_grade"), "symbol"
    )


def leg_product(plan: DataFrame, rights: Sequence[str], datasets: Sequence[str], exps: str = "exps") -> DataFrame:
    """One row per right, expiration (numbered from 0) and dataset of a plan."""
    return (
        plan.withColumn("opt_right", F.explode(F.array(*[F.lit(r) for r in rights])))
        .withColumn("dataset", F.explode(F.array(*[F.lit(d) for d in datasets])))
        .select("*", F.posexplode(exps).alias("leg", "exp"))
    )
