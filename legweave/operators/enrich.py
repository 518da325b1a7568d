"""Earnings, grades, cost history and other dimensions on calendar rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.functions.numeric import round_half_even
from legweave.skew import salted_join

GRADE = "undmean_avg_trade_class_combined_grade"

# Fixed values of the grade tables.
MIN_MAX_GRADE = 1.25
MAX_PLAN_WEEKS = 5
MAX_PLAN_BDTE = 20
AVERAGE_ROW = "Average"


def upcoming(earnings: DataFrame, max_bdte: int = MAX_PLAN_BDTE, column: str = "bdte") -> DataFrame:
    return earnings.filter(F.col(column) <= max_bdte)


def well_graded_symbols(grades: DataFrame, at_least: float = MIN_MAX_GRADE) -> DataFrame:
    """Symbols whose best grade reaches the threshold."""
    return grades.groupBy("symbol").agg(F.max(GRADE).alias("best_grade")).filter(F.col("best_grade") >= at_least)


def weeks_as_int(df: DataFrame) -> DataFrame:
    """Drops the summary rows and makes ``weeks`` a number."""
    return df.filter(F.col("weeks") != AVERAGE_ROW).withColumn("weeks", F.col("weeks").cast("int"))


def plan_grades(grades: DataFrame) -> DataFrame:
    """Latest grades for up to five weeks of well graded symbols."""
    current = weeks_as_int(grades.filter("latest")).filter(F.col("weeks") <= MAX_PLAN_WEEKS).drop("latest")
    return current.join(well_graded_symbols(grades).select("symbol"), "symbol", "left_semi")


def grades_with_earnings(grades: DataFrame, earnings: DataFrame) -> DataFrame:
    return grades.join(earnings, "symbol")


def new_columns(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` without the columns that ``df`` already has."""
    return dim.drop(*[n for n in dim.columns if n in df.columns and n not in keys])


def with_earnings_and_grades(df: DataFrame, earnings: DataFrame, grades: DataFrame) -> DataFrame:
    facts = salted_join(
        df, earnings.select("symbol", "noOfEsts", "epsForecast", "bdte", "dte"), ["symbol"]
    )
    return salted_join(facts, grades, ["symbol", "weeks"])


def latest_cost_stats(cost_stats: DataFrame) -> DataFrame:
    """Latest cost history, weeks as a number, mean rounded to four digits."""
    return (
        cost_stats.filter("latest")
        .drop("latest")
        .withColumns({"weeks": F.col("weeks").cast("int"), "calCostPctMean": round_half_even("calCostPctMean", 4)})
    )


def with_cost_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """The cost expected one day before the report, then today's cost history."""
    day_zero = stats.filter(F.col("bdte") == 1).select(
        "symbol", "weeks", F.col("calCostPctMean").alias("calCostPctMeanDayZero")
    )
    return salted_join(
        salted_join(df, day_zero, ["symbol", "weeks"]), stats, ["symbol", "bdte", "weeks"]
    )


def with_sector(df: DataFrame, sectors: DataFrame) -> DataFrame:
    return salted_join(df, sectors.select("symbol", "sector"), ["symbol"])


def with_historical_grade(df: DataFrame, grades: DataFrame, latest: bool) -> DataFrame:
    """Backtest grades: the latest ones, or those of the row's own quarter."""
    return _with_backtest(df, weeks_as_int(grades).drop("Grade"), ["symbol", "weeks"], latest)


def with_backtest_aggs(df: DataFrame, aggs: DataFrame, latest: bool) -> DataFrame:
    """Backtest results, keyed by days to the report as well."""
    dim = aggs.drop("overmean_str_ratio", "undmean_str_ratio", "all_str_ratio")
    return _with_backtest(df, dim.withColumn("weeks", F.col("weeks").cast("int")), ["symbol", "weeks", "bdte"], latest)


def _with_backtest(df: DataFrame, dim: DataFrame, keys: list[str], latest: bool) -> DataFrame:
    if latest:
        dim = dim.filter("latest").drop("latest", "targetFiscalQuarter")
        return salted_join(df, new_columns(df, dim, keys), keys)
    dim = dim.drop("latest").withColumnRenamed("targetFiscalQuarter", "fQuarter")
    return salted_join(df, dim, [*keys, "fQuarter"])


def with_comment(alerts: DataFrame, earnings: DataFrame) -> DataFrame:
    return salted_join(alerts, earnings.select("symbol", "comment", "sourceUsed"), ["symbol"], "left")


def in_symbols(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose symbol is in the set."""
    return salted_join(df, symbols.select("symbol").distinct(), ["symbol"], "left_semi")
