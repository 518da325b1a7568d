"""Queries for filters and gates (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.projection_queries import GAP_SQL, PAIR_IDS, chain_pairs
from legweave.catalog.registry import query
from legweave.functions.dates import in_session
from legweave.operators import alerts, enrich, expirations as ex, filters, planning, quality
from legweave.sources.csv_scan import drop_null_keys

IDS = "symbol, opt_right, strike_milli, exp, trade_date"
BAR_IDS = f"{IDS}, ms_of_day"


def cols(text: str) -> list[str]:
    return [t.strip() for t in text.split(",")]


def day_sql(x: str) -> str:
    return f"strptime(CAST({x} AS VARCHAR), '%Y%m%d')"


@query(
    "f01_open_interest",
    f"SELECT {PAIR_IDS}, open_interest_front, open_interest_back FROM pairs WHERE open_interest_front > 2 AND open_interest_back > 2",
)
def f01(spark, sf):
    return filters.open_interest_above(chain_pairs(spark, sf), 2).select(
        *cols(PAIR_IDS), "open_interest_front", "open_interest_back"
    )


LADDER_KEYS = ["symbol", "opt_right", "trade_date", "exp_front", "exp_back"]
RUNGS_SQL = ", ".join(f"({i}, {lo}e0, {hi}e0)" for i, (lo, hi) in enumerate(filters.ladder_rungs()))
RUNGS_SQL = RUNGS_SQL.replace("-0.0e0", "0.0e0").replace("e-05e0", "e-05")

# The rule step by step: the band, then per rung the rows it holds, then the
# first rung with enough rows.
define(
    "ladder",
    f"""SELECT * EXCLUDE (place) FROM (
  SELECT r.*, row_number() OVER (PARTITION BY symbol, opt_right, trade_date, exp_front, exp_back ORDER BY strike_milli) AS place
  FROM (
    SELECT b.* EXCLUDE (n, best, low, high) FROM (
      SELECT band.*, best, low, high FROM (
        SELECT *, count(*) OVER (PARTITION BY symbol, opt_right, trade_date, exp_front, exp_back) AS n FROM (
          SELECT *, (strike_milli / 1000 - underlying_front) / underlying_front AS x FROM pairs)
        WHERE x >= -0.003e0 AND x <= 0.05e0) band
      LEFT JOIN (
        SELECT symbol, opt_right, trade_date, exp_front, exp_back, min(i) AS best FROM (
          SELECT symbol, opt_right, trade_date, exp_front, exp_back, i, count(*) AS m
          FROM (SELECT *, (strike_milli / 1000 - underlying_front) / underlying_front AS x FROM pairs),
               (VALUES {RUNGS_SQL}) AS rungs(i, lo, hi)
          WHERE x >= lo AND x <= hi AND x >= -0.003e0 AND x <= 0.05e0 GROUP BY ALL) WHERE m >= 2 GROUP BY ALL) w
        USING (symbol, opt_right, trade_date, exp_front, exp_back)
      LEFT JOIN (SELECT i AS best, lo AS low, hi AS high FROM (VALUES {RUNGS_SQL}) AS rungs(i, lo, hi)) USING (best)) b
    WHERE n <= 2 OR best IS NULL OR (x >= low AND x <= high)) r)
WHERE place <= 2""",
)


@query("f02_near_the_money_ladder", f'SELECT {PAIR_IDS}, x AS "undPricePctDiff" FROM ladder')
def f02(spark, sf):
    pairs = chain_pairs(spark, sf).withColumn(
        "undPricePctDiff", F.try_divide(F.col("strike_milli") / 1000 - F.col("underlying_front"), F.col("underlying_front"))
    )
    return filters.near_the_money(pairs, LADDER_KEYS, 2).select(*cols(PAIR_IDS), "undPricePctDiff")


_LISTED = "(SELECT DISTINCT symbol, exp AS exp_{leg}, {what} FROM quotes)"
define(
    "leg_pairs",
    """SELECT f.symbol, f.exp AS exp_front, b.exp AS exp_back FROM (SELECT DISTINCT symbol, exp FROM quotes) f
  JOIN (SELECT DISTINCT symbol, exp FROM quotes) b ON f.symbol = b.symbol AND f.exp < b.exp""",
)
define(
    "pair_days",
    f"""SELECT symbol, exp_front, exp_back, min(trade_date) AS d0, max(trade_date) AS d1, CAST(count(*) AS INT) AS n_dates FROM leg_pairs
  JOIN {_LISTED.format(leg='front', what='trade_date')} f USING (symbol, exp_front) JOIN {_LISTED.format(leg='back', what='trade_date')} b USING (symbol, exp_back, trade_date)
  GROUP BY 1, 2, 3""",
)
define(
    "pair_strikes",
    f"""SELECT symbol, exp_front, exp_back, strike_milli, row_number() OVER (PARTITION BY symbol, exp_front, exp_back ORDER BY strike_milli) AS place,
  count(*) OVER (PARTITION BY symbol, exp_front, exp_back) AS n FROM leg_pairs
  JOIN {_LISTED.format(leg='front', what='strike_milli')} f USING (symbol, exp_front) JOIN {_LISTED.format(leg='back', what='strike_milli')} b USING (symbol, exp_back, strike_milli)""",
)


@query(
    "f03_strike_corridor",
    """SELECT symbol, exp_front, exp_back, strike_milli, min_und, max_und FROM pair_strikes JOIN (
      SELECT symbol, exp_front, exp_back, min(underlying) AS min_und, max(underlying) AS max_und FROM pair_days
      JOIN (SELECT symbol, exp_front, exp_back, strike_milli FROM pair_strikes WHERE place = n // 2 + 1) m USING (symbol, exp_front, exp_back)
      JOIN (SELECT symbol, exp AS exp_front, strike_milli, trade_date, underlying FROM greeks WHERE opt_right = 'C' AND underlying <> 0) g
        USING (symbol, exp_front, strike_milli) WHERE trade_date BETWEEN d0 AND d1 GROUP BY 1, 2, 3) u USING (symbol, exp_front, exp_back)
    WHERE strike_milli / 1000 > min_und * 0.94e0 AND strike_milli / 1000 < max_und * 1.06e0""",
)
def f03(spark, sf):
    """The corridor of every pair of listed expirations."""
    keys = ["symbol", "exp_front", "exp_back"]
    listed = ex.common_listing(ex.expiration_pairs(fx.quotes(spark, sf)), ex.contract_listing(fx.quotes(spark, sf)), 1)
    plans = listed.withColumn("strikes", F.array_sort("strikes"))
    ready = filters.strike_corridor(plans, fx.greeks(spark, sf), keys, "C")
    return ready.select(*keys, F.explode("strikes").alias("strike_milli"), "min_und", "max_und")


@query("f04_zero_underlying", f"SELECT {BAR_IDS}, underlying FROM greeks WHERE underlying <> 0")
def f04(spark, sf):
    return filters.nonzero_underlying(fx.greeks(spark, sf)).select(*cols(BAR_IDS), "underlying")


PRESET_SQL = """"histEarningsCount" >= 7 AND bdte BETWEEN 5 AND 12 AND pct_under_over_mean < 0 AND ask_size_back >= 10
  AND bid_size_back >= 10 AND ask_size_front >= 10 AND bid_size_front >= 10 AND "spreadPct_front" <= 0.3e0
  AND "spreadPct_back" <= 0.3e0 AND "spreadPct_cal" <= 0.6e0 AND "calCost" > 0.5e0 AND "calCost" < 10"""


@query("f05_alert_preset", f"SELECT row_id, symbol, weeks FROM candidates WHERE {PRESET_SQL}")
def f05(spark, sf):
    return alerts.passes_preset(fx.candidates(spark, sf)).select("row_id", "symbol", "weeks")


@query("f06_gap_threshold", f'SELECT row_id, weeks, "calGapPct" FROM candidates WHERE "calGapPct" < {GAP_SQL}')
def f06(spark, sf):
    return alerts.gap_below_limit(fx.candidates(spark, sf)).select("row_id", "weeks", "calGapPct")


@query(
    "f07_front_too_far",
    f"""SELECT symbol, report_date, exp FROM earnings, (SELECT unnest({fx.EXPIRATIONS}) AS exp)
      WHERE exp >= report_date AND date_diff('day', {day_sql('report_date')}, {day_sql('exp')}) < 7""",
)
def f07(spark, sf):
    exps = F.array(*[F.lit(e) for e in fx.EXPIRATIONS])
    rows = fx.earnings(spark, sf).select("symbol", "report_date", F.explode(exps).alias("exp"))
    return rows.filter((F.col("exp") >= F.col("report_date")) & ex.front_near_report("report_date", "exp"))


@query("f08_minimum_common_dates", "SELECT symbol, exp_front, exp_back, n_dates FROM pair_days WHERE n_dates >= 5")
def f08(spark, sf):
    """Pairs of listed expirations with five shared trade dates or more."""
    q = fx.quotes(spark, sf)
    return ex.common_listing(ex.expiration_pairs(q), ex.contract_listing(q), 5).select(
        "symbol", "exp_front", "exp_back", F.size("trade_dates").alias("n_dates")
    )


@query(
    "f09_result_gate",
    f"""SELECT {BAR_IDS} FROM hist SEMI JOIN (SELECT symbol, exp, strike_milli FROM hist GROUP BY 1, 2, 3
      HAVING count(DISTINCT trade_date) > 5) USING (symbol, exp, strike_milli)""",
)
def f09(spark, sf):
    return filters.enough_dates(fx.history(spark, sf), ["symbol", "exp", "strike_milli"]).select(*cols(BAR_IDS))


@query(
    "f10_edge_bars",
    f"""SELECT {BAR_IDS}, bid FROM (SELECT *, min(ms_of_day) OVER w AS lo, max(ms_of_day) OVER w AS hi FROM hist
      WINDOW w AS (PARTITION BY symbol, exp, trade_date)) WHERE ms_of_day <> lo AND ms_of_day <> hi""",
)
def f10(spark, sf):
    return filters.drop_edge_bars(fx.history(spark, sf), ["symbol", "exp", "trade_date"]).select(*cols(BAR_IDS), "bid")


@query(
    "f11_report_settled",
    f"SELECT symbol, report_date FROM earnings WHERE date_diff('day', {day_sql('report_date')}, DATE '2024-02-03') >= 14",
)
def f11(spark, sf):
    return planning.settled(fx.earnings(spark, sf), 20240203).select("symbol", "report_date")


@query(
    "f12_expiration_horizon",
    """SELECT 'days' AS rule, symbol, exp FROM (SELECT DISTINCT symbol, exp FROM chain) WHERE exp >= 20240126 AND exp <= 20240207
      UNION ALL SELECT 'instant', symbol, exp FROM (SELECT DISTINCT symbol, exp FROM chain) WHERE exp > 20240126 AND exp <= 20240425""",
)
def f12(spark, sf):
    """Whole days count the first day; an instant after midnight excludes it."""
    exps = ex.expirations_of(fx.chain(spark, sf))
    by_day = ex.within_horizon(exps, 20240126, 12).withColumn("rule", F.lit("days"))
    by_instant = ex.after_now_within(exps, "2024-01-26 09:30:00", 90).withColumn("rule", F.lit("instant"))
    return by_day.unionByName(by_instant)


@query(
    "f13_trading_date_bounds",
    f"SELECT DISTINCT symbol, exp, trade_date FROM quotes WHERE trade_date > 20240102 AND trade_date < 20240205 AND exp < 20240205",
)
def f13(spark, sf):
    days = fx.quotes(spark, sf).select("symbol", "exp", "trade_date").distinct()
    return ex.within_history(days, 20240102, 20240205)




@query(
    "f14_self_trading_expirations",
    """SELECT d.symbol, d.exp, d.trade_date FROM (
        SELECT DISTINCT symbol, exp, CASE WHEN trade_date = 20240111 AND open_interest > 1 THEN exp ELSE trade_date END AS trade_date FROM hist) d
      SEMI JOIN (SELECT DISTINCT symbol, exp FROM hist WHERE trade_date = 20240111 AND open_interest > 1) o
      ON d.symbol = o.symbol AND d.exp = o.exp""",
)
def f14(spark, sf):
    """Some listings trade on their own expiration day; the others are dropped."""
    own_day = (F.col("trade_date") == 20240111) & (F.col("open_interest") > 1)
    days = fx.history(spark, sf).select(
        "symbol", "exp", F.when(own_day, F.col("exp")).otherwise(F.col("trade_date")).alias("trade_date")
    )
    return ex.expires_on_trading_day(days.distinct())


@query("f15_null_keys", f"SELECT {BAR_IDS} FROM hist WHERE open_interest > 1")
def f15(spark, sf):
    gaps = fx.history(spark, sf).withColumn("ms_of_day", F.when(F.col("open_interest") > 1, F.col("ms_of_day")))
    return drop_null_keys(gaps).select(*cols(BAR_IDS))


@query(
    "f16_muted_tickers",
    """SELECT c.chat_id, row_id, symbol FROM candidates, (SELECT unnest(['c1', 'c2', 'c3']) AS chat_id) c
      WHERE NOT EXISTS (SELECT 1 FROM muted m WHERE m.chat_id = c.chat_id AND m.ticker = symbol AND mute_end > 20240110)""",
)
def f16(spark, sf):
    rows = alerts.for_chats(fx.candidates(spark, sf).select("row_id", "symbol"), ["c1", "c2", "c3"])
    return alerts.not_muted(rows, fx.muted(spark, sf), 20240110).select("chat_id", "row_id", "symbol")


@query(
    "f17_latest_version",
    'SELECT row_id, symbol, "lastUpdated" FROM candidates WHERE "lastUpdated" = (SELECT max("lastUpdated") FROM candidates)',
)
def f17(spark, sf):
    return alerts.latest_version(fx.candidates(spark, sf)).select("row_id", "symbol", "lastUpdated")


@query(
    "f18_session_hours",
    """SELECT event_id FROM (SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS ny FROM events)
      WHERE isodow(ny) <= 5 AND ny > date_trunc('day', ny) + INTERVAL 7 HOUR AND ny < date_trunc('day', ny) + INTERVAL 10 HOUR""",
)
def f18(spark, sf):
    return fx.events(spark, sf).filter(in_session("ts", 7, 10)).select("event_id")


@query(
    "f19_sql_predicates",
    """SELECT symbol, weeks, undmean_avg_trade_class_combined_grade AS grade FROM grades
      WHERE weeks <> 'Average' AND CAST(CASE WHEN weeks = 'Average' THEN '0' ELSE weeks END AS INT) <= 5 AND latest
        AND symbol IN (SELECT symbol FROM earnings WHERE bdte <= 20)""",
)
def f19(spark, sf):
    """Comparisons and set membership as filters and a semi join."""
    current = enrich.weeks_as_int(fx.grades(spark, sf).filter("latest")).filter(F.col("weeks") <= 5)
    chosen = enrich.in_symbols(current, enrich.upcoming(fx.earnings(spark, sf)))
    return chosen.select("symbol", F.col("weeks").cast("string").alias("weeks"), F.col("undmean_avg_trade_class_combined_grade").alias("grade"))


@query(
    "f20_quality_gates",
    """SELECT 'underlying' AS gate, symbol, exp FROM hist WHERE underlying <> 0 GROUP BY symbol, exp HAVING min(underlying) <> max(underlying)
      UNION ALL SELECT 'trade_date', symbol, exp FROM chain GROUP BY symbol, exp HAVING min(trade_date) <> max(trade_date)""",
)
def f20(spark, sf):
    """Groups that break a gate: several prices, or several dates, in one slice."""
    prices = quality.varying_within(filters.nonzero_underlying(fx.history(spark, sf)), ["symbol", "exp"], ["underlying"])
    dates = quality.varying_within(fx.chain(spark, sf), ["symbol", "exp"], ["trade_date"])
    return prices.select(F.lit("underlying").alias("gate"), "symbol", "exp").unionByName(
        dates.select(F.lit("trade_date").alias("gate"), "symbol", "exp")
    )


