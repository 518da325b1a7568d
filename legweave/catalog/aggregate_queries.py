"""Queries for aggregations (A*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.filter_queries import day_sql
from legweave.catalog.join_queries import TREND_SQL, rounded_trend
from legweave.catalog.projection_queries import round_sql
from legweave.catalog.registry import query
from legweave.operators import enrich, ivchain, planning, quality
from legweave.operators.filters import nonzero_underlying
from legweave.plans.features import matthews, snapshot_trend


@query("a01_price_trend", TREND_SQL)
def a01(spark, sf):
    return rounded_trend(snapshot_trend(fx.snapshot_log(spark, sf), fx.HOLIDAYS))


@query(
    "a02_mean_grade",
    "SELECT symbol, round(avg(undmean_avg_trade_class_combined_grade), 9) AS mean_grade FROM grades GROUP BY symbol",
)
def a02(spark, sf):
    out = planning.mean_grade(fx.grades(spark, sf), enrich.GRADE)
    return out.withColumn("mean_grade", F.round("mean_grade", 9))


@query(
    "a03_having_max",
    "SELECT symbol, max(undmean_avg_trade_class_combined_grade) AS best_grade FROM grades GROUP BY symbol HAVING max(undmean_avg_trade_class_combined_grade) >= 1.25e0",
)
def a03(spark, sf):
    return enrich.well_graded_symbols(fx.grades(spark, sf))


@query("a04_global_max_and_count", 'SELECT max("lastUpdated") AS newest, count(*) AS n FROM versions')
def a04(spark, sf):
    return fx.versions(spark, sf).agg(F.max("lastUpdated").alias("newest"), F.count("*").alias("n"))


define("near_greeks", f"SELECT * FROM greeks WHERE date_diff('day', {day_sql('trade_date')}, {day_sql('exp')}) BETWEEN 0 AND 90")
define(
    "modal",
    """SELECT symbol, trade_date, opt_right, strike_milli, n_exp FROM (
  SELECT *, max(n_exp) OVER (PARTITION BY symbol, trade_date, opt_right) AS most FROM (
    SELECT symbol, trade_date, opt_right, strike_milli, count(DISTINCT exp) AS n_exp FROM near_greeks GROUP BY 1, 2, 3, 4)) WHERE n_exp = most""",
)


@query("a05_modal_strikes", "SELECT symbol, trade_date, opt_right, strike_milli, n_exp FROM modal")
def a05(spark, sf):
    return ivchain.modal_strikes(ivchain.in_horizon(fx.greeks(spark, sf)))


@query("a05_few_modal_strikes", "SELECT symbol, trade_date, opt_right, count(*) AS n FROM modal GROUP BY 1, 2, 3 HAVING count(*) < 3")
def a05_few(spark, sf):
    """The warning case: symbols and rights with under three modal strikes."""
    return ivchain.few_modal_strikes(ivchain.modal_strikes(ivchain.in_horizon(fx.greeks(spark, sf))))


define("mean_und", f"SELECT symbol, trade_date, {round_sql('avg(underlying)', 2)} AS underlying FROM near_greeks GROUP BY 1, 2")
define(
    "nearest",
    """SELECT symbol, trade_date, opt_right, strike_milli, underlying FROM (
  SELECT symbol, trade_date, opt_right, strike_milli, underlying, row_number() OVER (PARTITION BY symbol, trade_date, opt_right
    ORDER BY abs(strike_milli - underlying * 1000), strike_milli) AS place FROM modal JOIN mean_und USING (symbol, trade_date)) WHERE place = 1""",
)


@query("a06_nearest_modal_strike", "SELECT symbol, trade_date, opt_right, strike_milli, underlying FROM nearest")
def a06(spark, sf):
    g = ivchain.in_horizon(fx.greeks(spark, sf))
    return ivchain.nearest_strike(ivchain.modal_strikes(g), ivchain.mean_underlying(g))


define("gpeaks", "SELECT symbol, trade_date, opt_right, exp FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date, opt_right ORDER BY implied_vol DESC, exp DESC) AS place FROM greeks WHERE implied_vol IS NOT NULL) WHERE place = 1")


@query("a07_iv_peak_expiration", "SELECT symbol, trade_date, opt_right, exp FROM gpeaks")
def a07(spark, sf):
    return ivchain.peak_expirations(fx.greeks(spark, sf))


@query(
    "a08_peaks_by_right",
    """SELECT symbol, trade_date, iv_max_exp_c, iv_max_exp_p, coalesce(iv_max_exp_c = iv_max_exp_p, false) AS iv_pc_max_same FROM (
      SELECT symbol, trade_date, max(CASE WHEN opt_right = 'C' THEN exp END) AS iv_max_exp_c, max(CASE WHEN opt_right = 'P' THEN exp END) AS iv_max_exp_p
      FROM gpeaks GROUP BY symbol, trade_date)""",
)
def a08(spark, sf):
    return ivchain.peaks_by_right(ivchain.peak_expirations(fx.greeks(spark, sf)))


@query(
    "a09_underlying_consensus",
    f"""SELECT symbol, trade_date, mean_price, greatest(abs(mean_price - lo), abs(mean_price - hi)) / nullif(mean_price, 0) AS deviation,
      coalesce(greatest(abs(mean_price - lo), abs(mean_price - hi)) / nullif(mean_price, 0) <= 0.0005e0, false) AS agrees FROM (
      SELECT symbol, trade_date, {round_sql('avg(price)', 2)} AS mean_price, min(price) AS lo, max(price) AS hi FROM (
        SELECT symbol, trade_date, exp, arg_min(underlying, strike_milli) AS price FROM sgreeks GROUP BY 1, 2, 3) GROUP BY 1, 2)""",
)
def a09(spark, sf):
    return quality.underlying_consensus(fx.snapshot_greeks(spark, sf), ["symbol", "trade_date"])


@query(
    "a10_underlying_range",
    "SELECT symbol, exp, min(underlying) AS low, max(underlying) AS high FROM greeks WHERE underlying <> 0 GROUP BY 1, 2",
)
def a10(spark, sf):
    return nonzero_underlying(fx.greeks(spark, sf)).groupBy("symbol", "exp").agg(
        F.min("underlying").alias("low"), F.max("underlying").alias("high")
    )


@query(
    "a11_distinct_counts",
    "SELECT exp, count(DISTINCT trade_date) AS n_dates, count(DISTINCT symbol) AS n_symbols FROM quotes GROUP BY exp",
)
def a11(spark, sf):
    return fx.quotes(spark, sf).groupBy("exp").agg(
        F.count_distinct("trade_date").alias("n_dates"), F.count_distinct("symbol").alias("n_symbols")
    )


@query(
    "a12_duplicate_detection",
    """SELECT symbol, exp, max(n) AS max_count FROM (SELECT symbol, exp, strike_milli, trade_date, count(*) AS n FROM oi GROUP BY 1, 2, 3, 4)
      GROUP BY 1, 2 HAVING max(n) > 1""",
)
def a12(spark, sf):
    return quality.duplicate_keys(fx.open_interest(spark, sf), ["symbol", "exp"], ["strike_milli", "trade_date"])


@query("a13_mean_underlying", "SELECT symbol, trade_date, underlying FROM mean_und")
def a13(spark, sf):
    return ivchain.mean_underlying(ivchain.in_horizon(fx.greeks(spark, sf)))


@query(
    "a14_matthews_correlation",
    """SELECT tp, tn, fp, fn, round(mcc, 9) AS mcc, round(-mcc, 9) AS loss FROM (SELECT *, coalesce((tp * tn - fp * fn) /
      nullif(sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn), 0), 0) AS mcc FROM (
      SELECT CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS DOUBLE) AS tn,
        CAST(count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS DOUBLE) AS fp, CAST(count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS DOUBLE) AS fn FROM labels))""",
)
def a14(spark, sf):
    out = matthews(fx.table(spark, sf, "labels"), "quality", "toxic")
    return out.withColumns({"mcc": F.round("mcc", 9), "loss": F.round("loss", 9)})


@query(
    "a16_null_counts",
    "SELECT count(*) FILTER (WHERE comment IS NULL) AS comment, count(*) FILTER (WHERE symbol IS NULL) AS symbol, count(*) FILTER (WHERE \"noOfEsts\" IS NULL) AS \"noOfEsts\" FROM earnings",
)
def a16(spark, sf):
    return quality.null_counts(fx.earnings(spark, sf), ["comment", "symbol", "noOfEsts"])
