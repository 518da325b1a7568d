"""Whole jobs, from landed tables to result."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.filter_queries import PRESET_SQL, cols, day_sql
from legweave.catalog.projection_queries import GAP_SQL, metric_sql, round_sql
from legweave.catalog.registry import query
from legweave.catalog.source_queries import landed_by_day
from legweave.functions.dates import EXCHANGE_ZONE, epoch_to_local_day
from legweave.functions.labels import iv_agreement, score_tier
from legweave.operators import alerts
from legweave.operators.ivchain import volatility_chain
from legweave.plans.best_calendars import best_calendars
from legweave.plans.equity_history import equity_history, history_failures, history_plan, history_roots
from legweave.plans.equity_snapshot import equity_snapshot
from legweave.plans.features import feature_frame
from legweave.plans.index_calendar import index_snapshot, recovered_calendars
from legweave.plans.multi_gap import multi_gap_history
from legweave.scratch import settle



def landed_chain(spark, sf):
    """The chain as a landed table: the jobs below read it several times."""
    return settle(fx.chain(spark, sf), "chain")


def landed_history(spark, sf):
    return settle(fx.history(spark, sf), "history")


@query(
    "job_best_calendars",
    f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, opt_right
        ORDER BY "calCost", trade_date, exp_front, exp_back, strike_milli) AS place FROM (
      SELECT symbol, opt_right, trade_date, exp_front, exp_back, strike_milli, {round_sql('strike_milli / 1000', 2)} AS strike,
        x AS "undPricePctDiff", {metric_sql('bid_front', 'ask_front', 'bid_back', 'ask_back', 'underlying_front', '')} FROM ladder)) WHERE place = 1""",
)
def job_best(spark, sf):
    return best_calendars(fx.chain(spark, sf))


def wide_metric_sql() -> str:
    parts = []
    for r in ("C", "P"):
        parts.append(f'("ask_{r}" - "bid_{r}") / 2 + "bid_{r}" AS "mark_{r}"')
        parts.append(f'("ask_{r}_G1" - "bid_{r}_G1") / 2 + "bid_{r}_G1" AS "mark_{r}_G1"')
        parts.append(metric_sql(f'"bid_{r}"', f'"ask_{r}"', f'"bid_{r}_G1"', f'"ask_{r}_G1"', "underlying", f"_{r}_G1"))
    return ", ".join(parts)


WIDE_VALUES = ["bid", "ask", "bid_size", "ask_size", "implied_vol", "delta"]


def _g1(names: list[str]) -> str:
    return ", ".join(f'b."{n}" AS "{n}_G1"' for n in names)


_OFF = "underlying + CASE WHEN symbol LIKE '%7' AND exp = 20240202 THEN 1e0 ELSE 0e0 END"
_NEAR = f"date_diff('day', {day_sql('trade_date')}, {day_sql('exp')}) BETWEEN 0 AND 60"
define(
    "agreed_days",
    f"""SELECT symbol, trade_date FROM (SELECT symbol, trade_date, {round_sql('avg(price)', 2)} AS mean_price, min(price) AS lo, max(price) AS hi FROM (
    SELECT symbol, trade_date, exp, arg_min({_OFF}, strike_milli) AS price FROM sgreeks WHERE {_NEAR} GROUP BY 1, 2, 3) GROUP BY 1, 2)
WHERE greatest(abs(mean_price - lo), abs(mean_price - hi)) / nullif(mean_price, 0) <= 0.0005e0""",
)
define("agreed_wide", f"SELECT * REPLACE ({_OFF} AS underlying) FROM wide SEMI JOIN agreed_days USING (symbol, trade_date) WHERE {_NEAR}")
define(
    "index_pairs",
    f"""SELECT f.* EXCLUDE (ms_of_day), CAST(floor((f.ms_of_day + b.ms_of_day) / 2) AS INT) AS ms_of_day,
  {_g1(['underlying', 'exp', *[f'{v}_{r}' for r in ('P', 'C') for v in WIDE_VALUES]])}
FROM agreed_wide f JOIN agreed_wide b ON f.symbol = b.symbol AND f.strike_milli = b.strike_milli AND f.trade_date = b.trade_date AND f.exp < b.exp
  AND date_diff('day', {day_sql('f.exp')}, {day_sql('b.exp')}) + 1 <= 10""",
)
INDEX_OUT = [
    "symbol", "strike_milli", "trade_date", "exp", "exp_G1", "ms_of_day", "underlying", "underlying_G1",
    *[f"{v}_{r}{g}" for r in ("P", "C") for v in ("bid_size", "ask_size", "implied_vol", "delta") for g in ("", "_G1")],
]


def days_sql(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {day_sql(start)}, {day_sql(end)}) AS INT)"


@query(
    "job_index_calendars",
    f"""SELECT {', '.join(f'"{n}"' for n in INDEX_OUT)}, {wide_metric_sql()},
      CAST(CAST((strike_milli / 1000 - underlying) / underlying AS FLOAT) AS DOUBLE) AS "undPricePctDiff",
      e.idx - t.idx AS bdtfexp, {days_sql('trade_date', 'exp')} AS dtfexp, g.idx - t.idx AS "bdtbexp_G1", {days_sql('trade_date', '"exp_G1"')} AS "dtbexp_G1"
      FROM index_pairs JOIN cal t ON trade_date = t.day JOIN cal e ON exp = e.day JOIN cal g ON "exp_G1" = g.day""",
)
def job_index(spark, sf):
    return index_run(spark, sf).calendars.withColumn("undPricePctDiff", F.col("undPricePctDiff").cast("double"))


def index_run(spark, sf):
    rows = landed_chain(spark, sf)
    # Some symbols' expirations disagree about the price, so their days drop out.
    off = F.when(F.col("symbol").endswith("7") & (F.col("exp") == 20240202), 1.0).otherwise(0.0)
    greeks = fx.snapshot_greeks_of(rows).withColumn("underlying", F.col("underlying") + off)
    return index_snapshot(greeks, fx.snapshot_quotes_of(rows), fx.HOLIDAYS)


define(
    "inner_bars",
    """SELECT * EXCLUDE (lo, hi) FROM (SELECT q.symbol, q.opt_right, q.strike_milli, q.exp, q.trade_date, q.ms_of_day, q.bid, q.ask, implied_vol,
  underlying, min(q.ms_of_day) OVER w AS lo, max(q.ms_of_day) OVER w AS hi
  FROM quotes q JOIN greeks g USING (symbol, opt_right, strike_milli, exp, trade_date, ms_of_day) WHERE trade_date BETWEEN 20240103 AND 20240110
  WINDOW w AS (PARTITION BY q.symbol, q.exp, q.trade_date)) WHERE ms_of_day <> lo AND ms_of_day <> hi""",
)
define(
    "recovered",
    """SELECT p.symbol, p.strike_milli, p.trade_date, p.ms_of_day, p.underlying, p.exp, p.bid AS "bid_P", p.ask AS "ask_P",
  p.implied_vol AS "implied_vol_P", c.bid AS "bid_C", c.ask AS "ask_C", c.implied_vol AS "implied_vol_C"
FROM inner_bars p JOIN inner_bars c ON p.symbol = c.symbol AND p.strike_milli = c.strike_milli AND p.trade_date = c.trade_date
  AND p.ms_of_day = c.ms_of_day AND p.underlying = c.underlying AND p.exp = c.exp WHERE p.opt_right = 'P' AND c.opt_right = 'C'""",
)
define(
    "recovered_pairs",
    f"""SELECT f.*, {_g1(['exp', 'bid_P', 'ask_P', 'implied_vol_P', 'bid_C', 'ask_C', 'implied_vol_C'])} FROM recovered f JOIN recovered b
  ON f.symbol = b.symbol AND f.strike_milli = b.strike_milli AND f.trade_date = b.trade_date AND f.ms_of_day = b.ms_of_day AND f.exp < b.exp
  AND date_diff('day', {day_sql('f.exp')}, {day_sql('b.exp')}) + 1 <= 45 AND date_diff('day', DATE '2024-01-03', {day_sql('f.exp')}) + 1 <= 30""",
)


def iv_sql(r: str) -> str:
    f, b = f'"implied_vol_{r}"', f'"implied_vol_{r}_G1"'
    return f"""CAST(CAST(CASE WHEN {f} = 0 AND {b} = 0 THEN 0 WHEN {f} = 0 THEN 1 ELSE ({f} - {b}) / {f} END AS FLOAT) AS DOUBLE) AS "iv_pct_diff_{r}_G1\""""


RECOVERED_OUT = ["symbol", "strike_milli", "trade_date", "ms_of_day", "exp", "exp_G1", "underlying"]


@query(
    "job_recovered_calendars",
    f"""SELECT {', '.join(f'"{n}"' for n in RECOVERED_OUT)}, {wide_metric_sql()}, {iv_sql('C')}, {iv_sql('P')},
      e.idx - t.idx AS bdtfexp, g.idx - t.idx AS "bdtbexp_G1"
      FROM recovered_pairs JOIN cal t ON trade_date = t.day JOIN cal e ON exp = e.day JOIN cal g ON "exp_G1" = g.day""",
)
def job_recovered(spark, sf):
    rows = landed_history(spark, sf)
    g = fx.greeks_of(rows).select(*cols("symbol, opt_right, strike_milli, exp, trade_date, ms_of_day"), "implied_vol", "underlying")
    q = fx.quotes_of(rows).select(*cols("symbol, opt_right, strike_milli, exp, trade_date, ms_of_day"), "bid", "ask")
    out = recovered_calendars(g, q, fx.HOLIDAYS, 20240103, 20240110, 30)
    metric = [n for n in out.columns if n.startswith(("mark", "cal", "ask_cal", "bid_cal", "spread"))]
    iv = [F.col(f"iv_pct_diff_{r}_G1").cast("double").alias(f"iv_pct_diff_{r}_G1") for r in ("C", "P")]
    return out.select(*RECOVERED_OUT, *metric, *iv, "bdtfexp", "bdtbexp_G1")


# ------------------------------------------------------------ equity snapshot

define(
    "snap_listed",
    "SELECT DISTINCT symbol, exp FROM squotes",
)
define(
    "snap_plan",
    f"""SELECT symbol, weeks, report_date, exp_front, arg_min(exp_back, prio) AS exp_back FROM (
  SELECT symbol, weeks, report_date, exp_front, prio,
    CAST(strftime({day_sql('exp_front')} + INTERVAL 1 DAY * (7 * weeks + off), '%Y%m%d') AS INT) AS exp_back
  FROM (SELECT g.symbol, g.weeks, e.report_date, min(l.exp) AS exp_front FROM plan_grades g JOIN near_earnings e ON g.symbol = e.symbol
        JOIN snap_listed l ON l.symbol = e.symbol AND l.exp >= e.report_date GROUP BY 1, 2, 3),
       (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2), (5, 3), (6, -3)) AS o(prio, off)) t
  SEMI JOIN snap_listed l2 ON t.symbol = l2.symbol AND t.exp_back = l2.exp
WHERE exp_back >= report_date AND date_diff('day', {day_sql('report_date')}, {day_sql('exp_front')}) < 7 GROUP BY 1, 2, 3, 4""",
)
define(
    "snap_legs",
    f"""SELECT p.symbol, p.weeks, p.report_date, p.exp_front, p.exp_back, f.opt_right, f.trade_date, f.strike_milli, f.ms_of_day, f.underlying,
  f.bid AS bid_front, f.ask AS ask_front, b.bid AS bid_back, b.ask AS ask_back, f.bid_size AS bid_size_front, f.ask_size AS ask_size_front,
  b.bid_size AS bid_size_back, b.ask_size AS ask_size_back, f.implied_vol AS implied_vol_front, b.implied_vol AS implied_vol_back,
  f.open_interest AS open_interest_front, b.open_interest AS open_interest_back,
  (f.strike_milli / 1000 - f.underlying) / f.underlying AS x
FROM snap_plan p JOIN snap_contracts f ON p.symbol = f.symbol AND p.exp_front = f.exp
  JOIN snap_contracts b ON p.symbol = b.symbol AND p.exp_back = b.exp AND f.opt_right = b.opt_right AND f.trade_date = b.trade_date AND f.strike_milli = b.strike_milli""",
)
define(
    "snap_contracts",
    f"""SELECT * FROM squotes JOIN sgreeks USING (symbol, opt_right, strike_milli, exp, trade_date)
  LEFT JOIN soi USING (symbol, opt_right, strike_milli, exp, trade_date) WHERE opt_right = 'C'""",
)
_RUNGS = ", ".join(f"({i}, {(-0.00025 * i):.5f}e0, {(0.003 * i):.3f}e0)" for i in range(17))
define(
    "snap_near",
    f"""SELECT * EXCLUDE (n, best, place) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, weeks, trade_date ORDER BY strike_milli) AS place FROM (
  SELECT b.* FROM (SELECT band.*, best FROM (SELECT *, count(*) OVER (PARTITION BY symbol, weeks, trade_date) AS n FROM snap_legs WHERE x >= -0.003e0 AND x <= 0.05e0) band
    LEFT JOIN (SELECT symbol, weeks, trade_date, min(i) AS best FROM (SELECT symbol, weeks, trade_date, i, count(*) AS m FROM snap_legs, (VALUES {_RUNGS}) AS r(i, lo, hi)
      WHERE x >= lo AND x <= hi AND x >= -0.003e0 AND x <= 0.05e0 GROUP BY ALL) WHERE m >= 2 GROUP BY ALL) USING (symbol, weeks, trade_date)) b
  LEFT JOIN (VALUES {_RUNGS}) AS r2(i, lo, hi) ON best = i
  WHERE n <= 2 OR best IS NULL OR (x >= lo AND x <= hi))) WHERE place <= 2""",
)
define("near_sgreeks", f"SELECT * FROM sgreeks WHERE date_diff('day', {day_sql('trade_date')}, {day_sql('exp')}) BETWEEN 0 AND 90")
define(
    "snap_modal",
    """SELECT symbol, trade_date, opt_right, strike_milli FROM (SELECT *, max(n) OVER (PARTITION BY symbol, trade_date, opt_right) AS most FROM (
  SELECT symbol, trade_date, opt_right, strike_milli, count(DISTINCT exp) AS n FROM near_sgreeks GROUP BY 1, 2, 3, 4)) WHERE n = most""",
)
define(
    "snap_nearest",
    f"""SELECT symbol, trade_date, opt_right, arg_min(strike_milli, (abs(strike_milli - underlying * 1000), strike_milli)) AS strike_milli
FROM snap_modal JOIN (SELECT symbol, trade_date, {round_sql('avg(underlying)', 2)} AS underlying FROM near_sgreeks GROUP BY 1, 2) USING (symbol, trade_date)
GROUP BY 1, 2, 3""",
)
define(
    "snap_chain_peaks",
    """SELECT symbol, trade_date, max(CASE WHEN opt_right = 'C' THEN exp END) AS iv_max_exp_c, max(CASE WHEN opt_right = 'P' THEN exp END) AS iv_max_exp_p
FROM (SELECT symbol, trade_date, opt_right, arg_max(exp, (implied_vol, exp)) AS exp
  FROM near_sgreeks JOIN snap_nearest USING (symbol, trade_date, opt_right, strike_milli) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
define(
    "snapshot",
    f"""SELECT n.symbol, n.weeks, n.report_date, n.exp_front, n.exp_back, n.opt_right, n.trade_date, n.strike_milli, n.underlying,
  {round_sql('strike_milli / 1000', 2)} AS strike, x AS "undPricePctDiff", bid_size_front, ask_size_front, bid_size_back, ask_size_back,
  open_interest_front, open_interest_back, {metric_sql('bid_front', 'ask_front', 'bid_back', 'ask_back', 'n.underlying', '', True)},
  {round_sql('(ask_front - bid_front) / nullif((ask_front - bid_front)/2 + bid_front, 0)', 2)} AS "spreadPct_front",
  e.bdte, e.dte, "noOfEsts", "Grade", undmean_avg_trade_class_combined_grade,
  z."calCostPctMean" AS "calCostPctMeanDayZero", s."calCostPctMean", s."histEarningsCount", s."calCostPctMean" / 100 * n.underlying AS "avgCalCost",
  z."calCostPctMean" / 100 * n.underlying AS "expectedCalCost", iv_max_exp_c, iv_max_exp_p,
  coalesce(iv_max_exp_c = exp_front, false) AND coalesce(iv_max_exp_p = exp_front, false) AS iv_consensus, c2.idx - c1.idx AS bdtfexp
FROM snap_near n JOIN near_earnings e ON n.symbol = e.symbol JOIN plan_grades g ON n.symbol = g.symbol AND n.weeks = g.weeks
  JOIN stats z ON n.symbol = z.symbol AND n.weeks = z.weeks AND z.bdte = 1
  JOIN stats s ON n.symbol = s.symbol AND n.weeks = s.weeks AND e.bdte = s.bdte
  JOIN snap_chain_peaks k ON n.symbol = k.symbol AND n.trade_date = k.trade_date JOIN cal c1 ON n.trade_date = c1.day JOIN cal c2 ON n.exp_front = c2.day""",
)

SNAP_OUT = [
    "symbol", "weeks", "report_date", "exp_front", "exp_back", "opt_right", "trade_date", "strike_milli", "underlying", "strike",
    "undPricePctDiff", "bid_size_front", "ask_size_front", "bid_size_back", "ask_size_back", "open_interest_front", "open_interest_back",
    "calCost", "calCostPct", "calGapPct", "ask_cal", "bid_cal", "spread_cal", "mark_cal", "spreadPct_cal", "spreadPct_front", "bdte", "dte",
    "noOfEsts", "Grade", "undmean_avg_trade_class_combined_grade", "calCostPctMeanDayZero", "calCostPctMean", "histEarningsCount",
    "avgCalCost", "expectedCalCost", "iv_max_exp_c", "iv_max_exp_p", "iv_consensus", "bdtfexp",
]


def _snapshot(spark, sf, watch=None):
    rows = landed_chain(spark, sf)
    return equity_snapshot(
        fx.snapshot_quotes_of(rows),
        fx.snapshot_greeks_of(rows),
        fx.snapshot_open_interest_of(rows),
        fx.earnings(spark, sf),
        fx.grades(spark, sf),
        fx.cost_stats(spark, sf),
        fx.HOLIDAYS,
        watch=watch,
    )


@query("job_equity_snapshot", f"SELECT {', '.join(f'\"{n}\"' for n in SNAP_OUT)} FROM snapshot")
def job_snapshot(spark, sf):
    return _snapshot(spark, sf).select(*SNAP_OUT)


define(
    "snap_slices",
    """SELECT w.symbol, w.weeks, w.bdte, max(CASE WHEN place = 1 THEN "avg" END) AS pre_0_avg, max(CASE WHEN place = 3 THEN "count" END) AS pre_2_count
FROM (SELECT s.symbol, s.weeks, s.bdte, t."avg", t."count", t.bdte - s.bdte AS off, row_number() OVER (PARTITION BY s.symbol, s.weeks, s.bdte ORDER BY t.bdte) AS place
  FROM (SELECT DISTINCT symbol, weeks, bdte FROM snapshot) s JOIN trend t ON s.symbol = t.symbol AND s.weeks = t.weeks
  AND t.bdte BETWEEN s.bdte AND s.bdte + 3 AND t."count" > 4) w
GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE off <= 2) = 3 OR count(*) FILTER (WHERE off >= 1) = 3""",
)


@query(
    "m02_feature_frame",
    f"""SELECT symbol, strike, opt_right, exp_front, weeks, sector, all_pl_pct_mean, least(ask_size_front, bid_size_back) AS min_entry_size,
      greatest(ask_size_back, bid_size_front) AS max_exit_size, "calGapPct" - {GAP_SQL} AS "calGapPctAdjusted", pre_0_avg, pre_2_count,
      2024 AS year, round(cos(2 * pi() * (trade_date % 100) / 365), 9) AS cos_day, bdte
      FROM snapshot JOIN sectors USING (symbol) JOIN (SELECT * EXCLUDE (weeks), CAST(weeks AS INT) AS weeks FROM aggs WHERE latest) a USING (symbol, weeks, bdte)
      JOIN snap_slices USING (symbol, weeks, bdte)""",
)
def m02(spark, sf):
    snapshot = settle(_snapshot(spark, sf), "snapshot")
    frame = feature_frame(
        snapshot, fx.sectors(spark, sf), fx.backtest_aggs(spark, sf), fx.snapshot_log(spark, sf), fx.HOLIDAYS
    )
    return frame.select(
        "symbol", "strike", "opt_right", "exp_front", "weeks", "sector", "all_pl_pct_mean", "min_entry_size", "max_exit_size",
        "calGapPctAdjusted", "pre_0_avg", "pre_2_count", "year", F.round("cos_day", 9).alias("cos_day"), "bdte",
    )


@query(
    "job_volatility_chain",
    f"""SELECT g.symbol, g.opt_right, g.strike_milli, g.exp, g.trade_date, g.ms_of_day, implied_vol, n.underlying,
      {round_sql('g.strike_milli / 1000', 2)} AS strike,
      {round_sql(f"({round_sql('g.strike_milli / 1000', 2)} - n.underlying) / nullif(n.underlying, 0)", 3)} AS strike_pct_diff
      FROM near_greeks g JOIN nearest n ON g.symbol = n.symbol AND g.opt_right = n.opt_right AND g.strike_milli = n.strike_milli AND g.trade_date = n.trade_date""",
)
def job_chain(spark, sf):
    return volatility_chain(fx.greeks_of(landed_history(spark, sf))).select(
        "symbol", "opt_right", "strike_milli", "exp", "trade_date", "ms_of_day", "implied_vol", "underlying", "strike", "strike_pct_diff"
    )


# ------------------------------------------------------------- equity history

HIST_WEEKS = [1, 2, 3]
for _table in ("quotes", "greeks", "oi"):
    _lost = " WHERE NOT (t.exp = 20240126 AND t.symbol LIKE '%3')" if _table == "oi" else ""
    define(f"root_{_table}", f"SELECT r.symbol, t.* EXCLUDE (symbol) FROM {_table} t JOIN roots r ON t.symbol = r.root{_lost}")
define(
    "work",
    """SELECT symbol, report_date, "noOfEsts", "epsForecast", "fiscalQuarterEnding", weeks, "fQuarter", filepath FROM (
  SELECT e.*, weeks, concat(e."fiscalQuarterEnding" // 10000, 'Q', (e."fiscalQuarterEnding" // 100 % 100 + 2) // 3) AS "fQuarter",
    concat('calendar_C_', weeks, '_weeks/', symbol, '/', symbol, '_', "fQuarter") AS filepath
  FROM earnings e, (SELECT unnest([1, 2, 3]) AS weeks)
  WHERE date_diff('day', strptime(CAST(e.report_date AS VARCHAR), '%Y%m%d'), DATE '2024-02-12') >= 14 AND symbol IN (SELECT symbol FROM sectors))
WHERE filepath NOT IN (SELECT concat('calendar_C_2_weeks/', symbol, '/', symbol, '_2023Q4') FROM earnings WHERE dte < 5)""",
)
define("hist_listed", "SELECT DISTINCT symbol, exp FROM root_quotes")
define(
    "work_chosen",
    f"""SELECT symbol, report_date, "noOfEsts", "epsForecast", "fiscalQuarterEnding", weeks, "fQuarter", filepath, exp_front, arg_min(exp_back, prio) AS exp_back FROM (
  SELECT w.*, exp_front, prio, CAST(strftime({day_sql('exp_front')} + INTERVAL 1 DAY * (7 * weeks + off), '%Y%m%d') AS INT) AS exp_back
  FROM (SELECT w.*, (SELECT min(exp) FROM hist_listed l WHERE l.symbol = w.symbol AND l.exp >= w.report_date) AS exp_front FROM work w) w,
    (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2), (5, 3), (6, -3)) AS o(prio, off)) t
  SEMI JOIN hist_listed l2 ON t.symbol = l2.symbol AND t.exp_back = l2.exp
WHERE exp_back >= report_date AND date_diff('day', {day_sql('report_date')}, {day_sql('exp_front')}) < 7 GROUP BY ALL""",
)
define(
    "work_days",
    """SELECT symbol, weeks, "fQuarter", report_date, min(f.trade_date) AS d0, max(f.trade_date) AS d1 FROM work_chosen c
  JOIN (SELECT DISTINCT symbol, exp AS exp_front, trade_date FROM root_quotes) f USING (symbol, exp_front)
  JOIN (SELECT DISTINCT symbol, exp AS exp_back, trade_date FROM root_quotes) b USING (symbol, exp_back, trade_date)
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5""",
)
define(
    "work_strikes",
    """SELECT symbol, weeks, "fQuarter", report_date, strike_milli, row_number() OVER (PARTITION BY symbol, weeks, "fQuarter", report_date ORDER BY strike_milli) AS place,
  count(*) OVER (PARTITION BY symbol, weeks, "fQuarter", report_date) AS n FROM work_chosen c
  JOIN (SELECT DISTINCT symbol, exp AS exp_front, strike_milli FROM root_quotes) f USING (symbol, exp_front)
  JOIN (SELECT DISTINCT symbol, exp AS exp_back, strike_milli FROM root_quotes) b USING (symbol, exp_back, strike_milli)""",
)
define(
    "work_range",
    """SELECT c.symbol, c.weeks, c."fQuarter", c.report_date, min(underlying) AS lo, max(underlying) AS hi FROM work_chosen c
  JOIN work_days d USING (symbol, weeks, "fQuarter", report_date)
  JOIN (SELECT * FROM work_strikes WHERE place = n // 2 + 1) m USING (symbol, weeks, "fQuarter", report_date)
  JOIN root_greeks g ON g.symbol = c.symbol AND g.exp = c.exp_front AND g.strike_milli = m.strike_milli AND g.opt_right = 'C'
    AND g.trade_date BETWEEN d0 AND d1 AND g.underlying <> 0 GROUP BY 1, 2, 3, 4""",
)
define(
    "hist_legs",
    """SELECT c.symbol, c.weeks, c."fQuarter", c.report_date, c.filepath, c."fiscalQuarterEnding", c.exp_front, c.exp_back, s.strike_milli, f.trade_date, f.ms_of_day,
  f.bid AS bid_front, b.bid AS bid_back, gf.implied_vol AS iv_front, gb.implied_vol AS iv_back, gf.underlying
FROM work_chosen c JOIN work_days d USING (symbol, weeks, "fQuarter", report_date) JOIN work_range r USING (symbol, weeks, "fQuarter", report_date)
  JOIN work_strikes s ON s.symbol = c.symbol AND s.weeks = c.weeks AND s."fQuarter" = c."fQuarter" AND s.report_date = c.report_date
    AND s.strike_milli / 1000 > lo * 0.94e0 AND s.strike_milli / 1000 < hi * 1.06e0
  JOIN root_quotes f ON f.symbol = c.symbol AND f.exp = c.exp_front AND f.strike_milli = s.strike_milli AND f.opt_right = 'C' AND f.trade_date BETWEEN d0 AND d1
  JOIN root_quotes b ON b.symbol = c.symbol AND b.exp = c.exp_back AND b.strike_milli = s.strike_milli AND b.opt_right = 'C' AND b.trade_date = f.trade_date AND b.ms_of_day = f.ms_of_day
  JOIN root_greeks gf ON gf.symbol = c.symbol AND gf.exp = c.exp_front AND gf.strike_milli = s.strike_milli AND gf.opt_right = 'C' AND gf.trade_date = f.trade_date AND gf.ms_of_day = f.ms_of_day
  JOIN root_greeks gb ON gb.symbol = c.symbol AND gb.exp = c.exp_back AND gb.strike_milli = s.strike_milli AND gb.opt_right = 'C' AND gb.trade_date = f.trade_date AND gb.ms_of_day = f.ms_of_day""",
)
define(
    "first_oi",
    """SELECT symbol, opt_right, strike_milli, exp, trade_date, open_interest FROM (SELECT *, row_number() OVER (
  PARTITION BY symbol, opt_right, strike_milli, exp, trade_date ORDER BY ms_of_day, open_interest) AS place FROM root_oi) WHERE place = 1 AND opt_right = 'C'""",
)
for _leg in ("front", "back"):
    define(
        f"held_{_leg}",
        f"""SELECT DISTINCT c.symbol, c.weeks, c."fQuarter", c.report_date FROM work_chosen c
  JOIN work_days USING (symbol, weeks, "fQuarter", report_date) JOIN work_range USING (symbol, weeks, "fQuarter", report_date)
  JOIN work_strikes USING (symbol, weeks, "fQuarter", report_date) JOIN first_oi o
    ON o.symbol = c.symbol AND o.exp = c.exp_{_leg} AND o.strike_milli = work_strikes.strike_milli AND o.trade_date BETWEEN d0 AND d1
  WHERE work_strikes.strike_milli / 1000 > lo * 0.94e0 AND work_strikes.strike_milli / 1000 < hi * 1.06e0""",
    )
HISTORY_SQL = """SELECT h.*, strike_milli / 1000 AS strike,
  CASE WHEN a.open_interest IS NOT NULL AND b.open_interest IS NOT NULL THEN a.open_interest ELSE 0 END AS open_interest_front,
  CASE WHEN a.open_interest IS NOT NULL AND b.open_interest IS NOT NULL THEN b.open_interest ELSE 0 END AS open_interest_back
FROM hist_legs h LEFT JOIN (SELECT symbol, strike_milli, exp AS exp_front, trade_date, open_interest FROM first_oi) a USING (symbol, strike_milli, exp_front, trade_date)
  LEFT JOIN (SELECT symbol, strike_milli, exp AS exp_back, trade_date, open_interest FROM first_oi) b USING (symbol, strike_milli, exp_back, trade_date)
SEMI JOIN (SELECT symbol, weeks, "fQuarter", report_date FROM hist_legs GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT trade_date) > 5) k
  USING (symbol, weeks, "fQuarter", report_date) SEMI JOIN held_front USING (symbol, weeks, "fQuarter", report_date)
  SEMI JOIN held_back USING (symbol, weeks, "fQuarter", report_date)"""


@query("job_equity_history", HISTORY_SQL)
def job_history(spark, sf):
    return _history(spark, sf)[1].withColumnsRenamed(HISTORY_NAMES).select(*HISTORY_OUT)


HISTORY_OUT = [
    "symbol", "weeks", "fQuarter", "report_date", "filepath", "fiscalQuarterEnding", "exp_front", "exp_back", "strike_milli",
    "trade_date", "ms_of_day", "bid_front", "bid_back", "iv_front", "iv_back", "underlying", "strike",
    "open_interest_front", "open_interest_back",
]
HISTORY_NAMES = {
    "bid_quote_front": "bid_front", "bid_quote_back": "bid_back", "implied_vol_front": "iv_front", "implied_vol_back": "iv_back",
}


def _history(spark, sf):
    reports = fx.earnings(spark, sf).select("symbol", "report_date", "noOfEsts", "epsForecast", "fiscalQuarterEnding", "dte")
    done = reports.filter(F.col("dte") < 5).select(
        F.concat(F.lit("calendar_C_2_weeks/"), "symbol", F.lit("/"), "symbol", F.lit("_2023Q4")).alias("filepath")
    )
    symbols = fx.sectors(spark, sf).select("symbol")
    plan = history_plan(reports.drop("dte"), symbols, done, HIST_WEEKS, "C", fx.AS_OF)
    roots = history_roots(symbols, fx.aliases(spark, sf))
    rows = landed_by_day(fx.history(spark, sf), "history")
    # Some contracts' open interest is missing altogether, for whole legs too.
    interest = fx.open_interest_of(rows).filter(~((F.col("exp") == 20240126) & F.col("symbol").endswith("3")))
    return plan, equity_history(plan, fx.quotes_of(rows), fx.greeks_of(rows), interest, "C", roots)


@query(
    "job_history_failures",
    f"""SELECT DISTINCT filepath FROM work WHERE filepath NOT IN (SELECT filepath FROM ({HISTORY_SQL}))""",
)
def job_failures(spark, sf):
    """The units of work that gave nothing, as the ledger of failed work takes them."""
    plan, result = _history(spark, sf)
    return history_failures(plan, result)


# ---------------------------------------------------------- multi-gap history

# Calls of every other strike report another underlying than puts here, so that the kept one shows.
define("mg_bars", "SELECT * REPLACE (underlying + CASE WHEN opt_right = 'C' AND strike_milli % 2000 = 0 THEN 0.5e0 ELSE 0e0 END AS underlying) FROM daily")
_RUNS = [[*fx.EXPIRATIONS, fx.FAR_EXPIRATION][i : i + 4] for i in range(2)]
define(
    "run_bars",
    f"""SELECT m.*, r.exps, list_position(r.exps, m.exp) AS leg FROM mg_bars m
JOIN (SELECT unnest({_RUNS}) AS exps) r ON list_contains(r.exps, m.exp)""",
)
define(
    "run_days",
    """SELECT symbol, exps, min(trade_date) AS d0, max(trade_date) AS d1 FROM (
  SELECT symbol, exps, trade_date FROM run_bars GROUP BY 1, 2, 3 HAVING count(DISTINCT exp) = 4) GROUP BY 1, 2 HAVING count(*) >= 5""",
)
define(
    "run_strikes",
    """SELECT symbol, exps, list(strike_milli ORDER BY strike_milli) AS ks FROM (
  SELECT symbol, exps, strike_milli FROM run_bars GROUP BY 1, 2, 3 HAVING count(DISTINCT exp) = 4) GROUP BY 1, 2""",
)
define(
    "run_range",
    """SELECT symbol, exps, min(underlying) AS lo, max(underlying) AS hi FROM run_bars JOIN run_strikes USING (symbol, exps) JOIN run_days USING (symbol, exps)
  WHERE leg = 1 AND opt_right = 'C' AND underlying <> 0 AND strike_milli = ks[len(ks) // 2 + 1] AND trade_date BETWEEN d0 AND d1 GROUP BY 1, 2""",
)


def _cell(r: str, i: int, value: str) -> str:
    return f"max(CASE WHEN opt_right = '{r}' AND leg = {i + 1} THEN {value} END)"


MG_NAMES = ["front", "back_G1", "back_G2", "back_G3"]
define(
    "gap_rows",
    f"""SELECT symbol, exps, strike_milli, trade_date, ms_of_day, {_cell('P', 0, 'underlying')} AS underlying,
  {', '.join(f'{_cell(r, i, v)} AS "{v}_{r}_{n}"' for r in ('P', 'C') for i, n in enumerate(MG_NAMES) for v in ('bid', 'ask', 'implied_vol'))}
FROM run_bars JOIN run_days USING (symbol, exps) JOIN run_range USING (symbol, exps) JOIN run_strikes USING (symbol, exps)
WHERE trade_date BETWEEN d0 AND d1 AND list_contains(ks, strike_milli) AND strike_milli / 1000 > lo * 0.94e0 AND strike_milli / 1000 < hi * 1.06e0
GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 8""",
)


@query(
    "job_multi_gap_history",
    f"""SELECT g.* EXCLUDE (exps), {', '.join(f'exps[{i + 1}] AS "exp_{n}"' for i, n in enumerate(MG_NAMES))} FROM gap_rows g
      SEMI JOIN (SELECT symbol, exps FROM gap_rows GROUP BY 1, 2 HAVING count(DISTINCT trade_date) > 5) k USING (symbol, exps)""",
)
def job_multi_gap(spark, sf):
    return multi_gap_run(spark, sf).drop("exps")


def multi_gap_run(spark, sf, watch=None):
    d = landed_by_day(fx.daily(spark, sf), "daily")
    keys = ["symbol", "opt_right", "strike_milli", "exp", "trade_date", "ms_of_day"]
    odd = (F.col("opt_right") == "C") & (F.col("strike_milli") % 2000 == 0)
    price = F.col("underlying") + F.when(odd, 0.5).otherwise(0.0)
    return multi_gap_history(
        d.select(*keys, "bid", "ask"), d.select(*keys, "implied_vol", price.alias("underlying")), watch=watch
    )


# ---------------------------------------------------------------------- alerts


@query(
    "job_alerts",
    f"""SELECT c.symbol, c.weeks, c.row_id, c."lastUpdated" AS alert_time, m.chat_id, comment,
      CASE WHEN iv_max_exp_c = exp_front AND iv_max_exp_p = exp_front THEN 'High' WHEN iv_max_exp_c = exp_front THEN 'Medium (Calls)'
        WHEN iv_max_exp_p = exp_front THEN 'Medium (Puts)' ELSE 'Low' END AS agreement,
      CASE WHEN prediction_score_1 > 0.95e0 THEN 'top' WHEN prediction_score_1 > 0.9e0 THEN 'high' WHEN prediction_score_1 > 0.75e0 THEN 'good'
        WHEN prediction_score_1 > 0.5e0 THEN 'fair' WHEN prediction_score_1 > 0 THEN 'weak' ELSE 'none' END AS tier
      FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, weeks ORDER BY "undPricePctDiff", row_id) AS place FROM (
          SELECT * REPLACE ({round_sql('"calCost"', 3)} AS "calCost", {round_sql('"calGapPct"', 3)} AS "calGapPct",
            {round_sql('pct_under_over_mean', 3)} AS pct_under_over_mean, {round_sql('"spreadPct_front"', 2)} AS "spreadPct_front",
            {round_sql('"spreadPct_back"', 2)} AS "spreadPct_back", {round_sql('"spreadPct_cal"', 2)} AS "spreadPct_cal") FROM candidates
          WHERE undmean_avg_trade_class_combined_grade >= 1.25e0 AND "lastUpdated" = (SELECT max("lastUpdated") FROM candidates))
        WHERE {PRESET_SQL} AND "calGapPct" < {GAP_SQL}) WHERE place = 1) c
      LEFT JOIN (SELECT symbol, weeks, max("lastUpdated") AS last FROM candidates WHERE "lastUpdated" < {fx.SNAPSHOT_EPOCH} + 1800 AND row_id % 50 = 3 GROUP BY 1, 2) l
        ON c.symbol = l.symbol AND c.weeks = l.weeks
      LEFT JOIN earnings e ON c.symbol = e.symbol, (SELECT unnest(['c1', 'c2']) AS chat_id) m
      WHERE (last IS NULL OR c."lastUpdated" - last > 3600)
        AND NOT EXISTS (SELECT 1 FROM muted u WHERE u.chat_id = m.chat_id AND u.ticker = c.symbol AND u.mute_end > 20240110)""",
)
def job_alerts(spark, sf):
    """Latest scored calendars to the alerts of each chat."""
    c = F.col
    scored = fx.candidates(spark, sf)
    graded = scored.filter(c("undmean_avg_trade_class_combined_grade") >= 1.25)
    newest = graded.join(
        F.broadcast(scored.agg(F.max("lastUpdated").alias("lastUpdated"))), "lastUpdated", "left_semi"
    )
    kept = alerts.gap_below_limit(alerts.passes_preset(alerts.rounded(newest)))
    best = alerts.best_per_key(kept, ["row_id"]).withColumns(
        {"alert_time": c("lastUpdated"), "alert_date": epoch_to_local_day("lastUpdated", EXCHANGE_ZONE)}
    )
    log = scored.filter((c("lastUpdated") < fx.SNAPSHOT_EPOCH + 1800) & (c("row_id") % 50 == 3)).select(
        "symbol", "weeks", c("lastUpdated").alias("alert_time"), epoch_to_local_day("lastUpdated", EXCHANGE_ZONE).alias("alert_date")
    )
    fresh = alerts.past_cooldown(best, log)
    commented = alerts.salted_join(fresh, fx.earnings(spark, sf).select("symbol", "comment"), ["symbol"], "left")
    shown = alerts.not_muted(alerts.for_chats(commented, ["c1", "c2"]), fx.muted(spark, sf), 20240110)
    both = (c("iv_max_exp_c") == c("exp_front")) & (c("iv_max_exp_p") == c("exp_front"))
    return alerts.in_alert_order(
        shown.select(
            "symbol", "weeks", "row_id", "alert_time", "chat_id", "comment",
            iv_agreement(both, "iv_max_exp_c", "iv_max_exp_p", "exp_front").alias("agreement"),
            score_tier("prediction_score_1").alias("tier"),
        )
    )
