"""Queries for window-shaped operators (W*) and ordering (T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.filter_queries import LADDER_KEYS, cols
from legweave.catalog.join_queries import rounded_trend
from legweave.catalog.projection_queries import PAIR_IDS, chain_pairs
from legweave.catalog.registry import query
from legweave.operators import alerts, enrich, expirations as ex, legs, planning
from legweave.operators.trading_calendar import calendar_over, span_bounds, trading_days, with_day_counts
from legweave.operators.trend import TREND_MEASURES, trend_slice
from legweave.plans.features import snapshot_trend
from legweave.schemas import CONTRACT_KEYS
from legweave.scratch import fresh_path
from legweave.sinks.writers import write_partitioned
from legweave.skew import top_k


@query(
    "w01_group_count_and_max",
    """SELECT symbol, symbol_changes, date, entries, last_entry FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS entries,
      max(date) OVER (PARTITION BY symbol) AS last_entry FROM aliases) WHERE entries >= 2 AND last_entry >= 20160101""",
)
def w01(spark, sf):
    return planning.active_symbols(fx.aliases(spark, sf))


@query(
    "w02_earliest_open_interest",
    """SELECT symbol, opt_right, strike_milli, exp, trade_date, open_interest FROM (SELECT *, row_number() OVER (
      PARTITION BY symbol, opt_right, strike_milli, exp, trade_date ORDER BY ms_of_day, open_interest) AS place FROM oi) WHERE place = 1""",
)
def w02(spark, sf):
    return legs.earliest_per_day(fx.open_interest(spark, sf), CONTRACT_KEYS)


@query(
    "w02_best_alert_per_key",
    """SELECT symbol, weeks, row_id, "undPricePctDiff" FROM (SELECT *, row_number() OVER (PARTITION BY symbol, weeks
      ORDER BY "undPricePctDiff", row_id) AS place FROM candidates) WHERE place = 1""",
)
def w02_best(spark, sf):
    best = alerts.best_per_key(fx.candidates(spark, sf), ["row_id"])
    return best.select("symbol", "weeks", "row_id", "undPricePctDiff")


@query(
    "w03_last_trading_days",
    """SELECT symbol, exp, trade_date FROM (SELECT *, row_number() OVER (PARTITION BY symbol, exp ORDER BY trade_date DESC) AS place
      FROM (SELECT DISTINCT symbol, exp, trade_date FROM quotes)) WHERE place <= 3""",
)
def w03(spark, sf):
    days = fx.quotes(spark, sf).select("symbol", "exp", "trade_date").distinct()
    return ex.last_trading_days(days, 3)


@query(
    "w04_expiration_runs",
    """SELECT DISTINCT symbol, concat(e1, '_', e2, '_', e3) AS run FROM (SELECT symbol, trade_date, exp AS e1,
      lead(exp, 1) OVER w AS e2, lead(exp, 2) OVER w AS e3 FROM (SELECT DISTINCT symbol, trade_date, exp FROM quotes)
      WINDOW w AS (PARTITION BY symbol, trade_date ORDER BY exp)) WHERE e3 IS NOT NULL""",
)
def w04(spark, sf):
    runs = ex.expiration_runs(fx.quotes(spark, sf), 3)
    return runs.select("symbol", F.concat_ws("_", F.col("exps").cast("array<string>")).alias("run"))




@query(
    "w05_trading_day_counts",
    """SELECT symbol, trade_date, exp, report_date, e.idx - t.idx AS bdtfexp,
      CAST(date_diff('day', strptime(CAST(trade_date AS VARCHAR), '%Y%m%d'), strptime(CAST(exp AS VARCHAR), '%Y%m%d')) AS INT) AS dtfexp,
      r.idx - e.idx AS bdte_x,
      CAST(date_diff('day', strptime(CAST(exp AS VARCHAR), '%Y%m%d'), strptime(CAST(report_date AS VARCHAR), '%Y%m%d')) AS INT) AS dte_x
      FROM (SELECT DISTINCT symbol, trade_date, exp FROM quotes) JOIN earnings USING (symbol)
      JOIN cal t ON trade_date = t.day JOIN cal e ON exp = e.day JOIN cal r ON report_date = r.day""",
)
def w05(spark, sf):
    """Counts to the front expiration, and from it to the report (often negative)."""
    days = fx.quotes(spark, sf).select("symbol", "trade_date", "exp").distinct()
    rows = days.join(fx.earnings(spark, sf).select("symbol", "report_date"), "symbol")
    counted = with_day_counts(rows, fx.HOLIDAYS, "trade_date", "exp", "fexp")
    return with_day_counts(counted, fx.HOLIDAYS, "exp", "report_date", "earnings", "x")


@query(
    "w06_trading_calendar",
    """SELECT day FROM cal WHERE is_open AND day >= (SELECT min(trade_date) FROM quotes)
      AND day <= (SELECT greatest((SELECT max(exp) FROM quotes), (SELECT max(report_date) FROM earnings)))""",
)
def w06(spark, sf):
    spans = fx.quotes(spark, sf).select("trade_date", "exp").unionByName(
        fx.earnings(spark, sf).select(F.col("report_date").alias("exp")), allowMissingColumns=True
    )
    return trading_days(calendar_over(span_bounds(spans, "trade_date", "exp"), fx.HOLIDAYS))


@query(
    "w08_trend_slice",
    f"SELECT symbol, weeks, bdte, {', '.join(f'\"pre_{i}_{m}\"' for i in range(3) for m in TREND_MEASURES)} FROM slices",
)
def w08(spark, sf):
    trades = fx.candidates(spark, sf).select("symbol", "weeks", "bdte")
    return trend_slice(trades, rounded_trend(snapshot_trend(fx.snapshot_log(spark, sf), fx.HOLIDAYS)))


@query("t01_result_order", "SELECT symbol, strike_milli, trade_date, ms_of_day, exp, opt_right, bid FROM hist")
def t01(spark, sf):
    """Files are written in strike, date and time order within each partition."""
    path = fresh_path(spark, "sorted")
    rows = fx.history(spark, sf).select("symbol", "strike_milli", "trade_date", "ms_of_day", "exp", "opt_right", "bid")
    write_partitioned(rows, path, ["exp"], sort=["symbol", "strike_milli", "trade_date", "ms_of_day"])
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "t02_priority_order",
    """SELECT symbol, round(mean_grade, 9) AS mean_grade
      FROM (SELECT e.symbol, avg(undmean_avg_trade_class_combined_grade) AS mean_grade FROM (SELECT DISTINCT symbol FROM quotes) e
        LEFT JOIN grades g ON e.symbol = g.symbol GROUP BY 1)
      ORDER BY mean_grade DESC NULLS LAST, symbol""",
)
def t02(spark, sf):
    """Every quoted symbol; the old names of renamed ones have no grade."""
    symbols = fx.quotes(spark, sf).select("symbol").distinct()
    ordered = planning.by_priority(symbols, fx.grades(spark, sf), enrich.GRADE)
    return ordered.select("symbol", F.round("mean_grade", 9).alias("mean_grade"))


@query(
    "t03_head_per_snapshot",
    f"""SELECT {PAIR_IDS} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(LADDER_KEYS)} ORDER BY strike_milli) AS place
      FROM pairs) WHERE place <= 2""",
)
def t03(spark, sf):
    return top_k(chain_pairs(spark, sf), LADDER_KEYS, [F.asc("strike_milli")], 2).select(*cols(PAIR_IDS))


@query(
    "t04_first_three",
    """SELECT symbol, weeks, bdte FROM (SELECT symbol, weeks, bdte, row_number() OVER (PARTITION BY symbol, weeks ORDER BY bdte) AS place
      FROM trend WHERE "count" > 4) WHERE place <= 3""",
)
def t04(spark, sf):
    rows = snapshot_trend(fx.snapshot_log(spark, sf), fx.HOLIDAYS).filter(F.col("count") > 4)
    return top_k(rows, ["symbol", "weeks"], [F.asc("bdte")], 3).select("symbol", "weeks", "bdte")


@query(
    "t05_alert_order",
    """SELECT symbol, weeks, row_id, "undPricePctDiff" FROM (SELECT *, row_number() OVER (PARTITION BY symbol, weeks
      ORDER BY "undPricePctDiff", row_id) AS place FROM candidates) WHERE place = 1 ORDER BY symbol, weeks""",
)
def t05(spark, sf):
    best = alerts.best_per_key(fx.candidates(spark, sf), ["row_id"])
    return alerts.in_alert_order(best.select("symbol", "weeks", "row_id", "undPricePctDiff"))
