"""DuckDB text of the derived tables in ``legweave.fixtures``."""

from __future__ import annotations

import re

from legweave import fixtures as fx

EXPS = str(fx.EXPIRATIONS)
DAYS = str(fx.HISTORY_DAYS)
EXP_SQL = f"CASE WHEN l_partkey % {fx.FAR_EVERY} = 0 THEN {fx.FAR_EXPIRATION} ELSE {EXPS}[CAST(l_partkey % 4 AS INT) + 1] END"


def _history(n_days: int, n_bars: int) -> str:
    return f"""
SELECT concat(CASE WHEN l_suppkey % 10 = 0 AND d < 2 THEN 'O' ELSE 'S' END, l_suppkey) AS symbol, opt_right, strike_milli, exp,
  {DAYS}[d + 1] AS trade_date, ms_of_day,
  floor(min_price)/1000 AS bid, floor(min_price)/1000 + max_disc AS ask,
  CAST(min_qty AS INT) AS bid_size, CAST(max_qty AS INT) AS ask_size,
  CASE WHEN (l_suppkey + d) % 17 = 0 THEN 0.0e0
       ELSE floor(10000 + s_acctbal/50)/100 + d * 0.25e0 END AS underlying,
  CASE WHEN max_tax < 0.015e0 THEN 0.0e0 ELSE 0.2e0 + max_tax END AS implied_vol,
  open_interest
FROM (
  SELECT l_suppkey, CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS opt_right,
    CAST(98000 + 1000*l_linenumber AS BIGINT) AS strike_milli,
    {EXP_SQL} AS exp,
    CAST(l_orderkey % {n_days} AS INT) AS d,
    CAST({fx.OPEN_MS} + ((l_partkey // 4) % {n_bars}) * {fx.BAR_MS} AS INT) AS ms_of_day,
    min(l_extendedprice) AS min_price, max(l_discount) AS max_disc, min(l_quantity) AS min_qty,
    max(l_quantity) AS max_qty, max(l_tax) AS max_tax, count(*) AS open_interest
  FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6
) JOIN supplier ON l_suppkey = s_suppkey"""


CTES: dict[str, str] = {
    "chain": f"""
SELECT concat('S', l_suppkey) AS symbol,
  CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS opt_right,
  CAST(98000 + 1000*l_linenumber AS BIGINT) AS strike_milli,
  {EXP_SQL} AS exp,
  CAST(20240107 + quarter(l_shipdate) AS INT) AS trade_date,
  floor(min(l_extendedprice))/1000 AS bid,
  floor(min(l_extendedprice))/1000 + max(l_discount) AS ask,
  CAST(min(l_quantity) AS INT) AS bid_size, CAST(max(l_quantity) AS INT) AS ask_size,
  floor(10000 + min(s_acctbal)/50)/100 AS underlying,
  0.2e0 + max(l_tax) AS implied_vol, count(*) AS open_interest
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4, 5""",
    "hist": _history(8, 3),
    "daily": _history(6, 1),
    "squotes": "SELECT symbol, opt_right, strike_milli, exp, trade_date, bid_size, bid, ask_size, ask FROM chain",
    "sgreeks": f"""SELECT symbol, opt_right, strike_milli, exp, trade_date,
  CAST({fx.OPEN_MS} + bid_size * 10 AS INT) AS ms_of_day, bid_size/64 AS delta, implied_vol, underlying FROM chain""",
    "soi": "SELECT symbol, opt_right, strike_milli, exp, trade_date, open_interest FROM chain WHERE bid_size <= 40",
    "quotes": """SELECT symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, bid_size,
  50 AS bid_condition, 1 AS bid_exchange, bid, ask_size, 50 AS ask_condition, 2 AS ask_exchange, ask FROM hist""",
    "greeks": """SELECT symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, bid, ask,
  bid_size/64 AS delta, ask_size/-64 AS theta, open_interest/4 AS vega, implied_vol, underlying
FROM hist WHERE open_interest > 1 OR ask_size > 5""",
    "oi": """SELECT symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, open_interest
FROM hist WHERE bid_size <= 40""",
    "cal": f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS day, is_open,
  CAST(coalesce(sum(CAST(is_open AS INT)) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS idx
FROM (SELECT d, isodow(d) <= 5 AND CAST(strftime(d, '%Y%m%d') AS INT) NOT IN ({', '.join(map(str, fx.HOLIDAYS))}) AS is_open
      FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d))""",
    "earnings": """
SELECT concat('S', s_suppkey) AS symbol, CAST(CASE n WHEN 1 THEN 20240415 ELSE 20240115 END + s_suppkey % 9 AS INT) AS report_date,
  s_nationkey AS "noOfEsts", floor(s_acctbal)/1000 AS "epsForecast",
  CASE WHEN n = 1 THEN 20240331 WHEN s_suppkey % 2 = 0 THEN 20231231 ELSE 20230930 END AS "fiscalQuarterEnding",
  CAST(CASE WHEN n = 1 THEN 70 WHEN s_suppkey % 6 = 5 THEN s_suppkey % 12 + 15 ELSE s_suppkey % 12 + 1 END AS INT) AS bdte,
  CAST(CASE WHEN n = 1 THEN 97 ELSE s_suppkey % 25 END AS INT) AS dte,
  CASE s_suppkey % 5 WHEN 0 THEN 'Same Date' WHEN 1 THEN ' same week ' WHEN 2 THEN 'Different Week'
       WHEN 3 THEN 'unconfirmed' END AS comment,
  concat('src', s_suppkey % 3) AS "sourceUsed" FROM supplier, (SELECT unnest([0, 1]) AS n) WHERE n = 0 OR s_suppkey % 4 = 0""",
    "past_earnings": """
SELECT concat('S', s_suppkey) AS symbol,
  CAST(strftime(DATE '2024-01-15' + CAST(s_suppkey % 9 - n * 91 * (s_suppkey % 3 + 1) AS INT), '%Y%m%d') AS INT) AS report_date
FROM supplier, (SELECT unnest(range(8)) AS n) WHERE s_suppkey % 10 <> 9 OR n = 0""",
    "grades": """
SELECT concat('S', s_suppkey) AS symbol, CASE WHEN w = 0 THEN 'Average' ELSE CAST(w AS VARCHAR) END AS weeks, latest,
  CASE WHEN latest THEN '2023Q4' ELSE '2023Q3' END AS "targetFiscalQuarter",
  CASE WHEN floor(s_acctbal)/5000 > 1 THEN 'A' ELSE 'B' END AS "Grade",
  floor(s_acctbal)/5000 + w * 0.125e0 AS undmean_avg_trade_class_combined_grade,
  floor(s_acctbal)/5000 + w * 0.125e0 + 0.25e0 AS all_avg_trade_class_combined_grade,
  floor(s_acctbal)/5000 + w * 0.125e0 - 0.25e0 AS overmean_avg_trade_class_combined_grade
FROM supplier, (SELECT unnest(range(7)) AS w), (SELECT unnest([true, false]) AS latest)""",
    "aggs": """
SELECT concat('S', k) AS symbol, CAST(w AS VARCHAR) AS weeks, CAST(b AS INT) AS bdte, (k + w) % 5 <> 0 AS latest,
  CASE WHEN (k + w) % 5 <> 0 THEN '2023Q4' ELSE '2023Q3' END AS "targetFiscalQuarter",
  k % 7 / 8 AS all_str_ratio, k % 5 / 8 AS undmean_str_ratio, k % 3 / 8 AS overmean_str_ratio,
  (k * 3 + b) % 40 / 8 AS all_pl_pct_mean, (k + b) % 30 + 1 AS all_total_trades,
  (k + w * b) % 16 / 16 AS all_win_rate, (k * 5 + w) % 32 / 8 AS undmean_pl_pct_mean,
  (k * 7 + b + w) % 32 / 8 AS overmean_pl_pct_mean
FROM (SELECT s_suppkey AS k FROM supplier), (SELECT unnest(range(1, 7)) AS w), (SELECT unnest(range(0, 16)) AS b)""",
    "cost_stats": """
SELECT concat('S', k) AS symbol, CAST(b AS INT) AS bdte, CAST(w AS VARCHAR) AS weeks,
  (k * 7 + b + w) % 50 / 8 + 0.5e0 AS "calCostPctMean", ((k * 7 + b + w) % 50 / 8 + 0.5e0) / 4 AS "calCostPctStd",
  ((k * 7 + b + w) % 50 / 8 + 0.5e0) * 2 AS "calCostPctMax", ((k * 7 + b + w) % 50 / 8 + 0.5e0) / 8 AS "calCostPctMin",
  k % 12 + 4 AS "histEarningsCount", k % 20 + 4 AS "histCalCostCount", k % 8 <> 7 AS latest
FROM (SELECT s_suppkey AS k FROM supplier), (SELECT unnest(range(1, 6)) AS w), (SELECT unnest(range(0, 13)) AS b)""",
    "aliases": """SELECT concat('S', s_suppkey) AS symbol, concat(CASE n WHEN 0 THEN 'O' ELSE 'S' END, s_suppkey) AS symbol_changes,
  CAST(CASE WHEN s_suppkey % 40 = 0 THEN 20140106 ELSE 20180105 END + n AS INT) AS date
FROM supplier, (SELECT unnest([0, 1]) AS n) WHERE s_suppkey % 10 = 0 AND (n = 0 OR s_suppkey % 20 = 0)""",
    "roots": """SELECT concat('S', s_suppkey) AS symbol, concat('S', s_suppkey) AS root FROM supplier
UNION SELECT symbol, symbol_changes FROM aliases WHERE symbol IN (
  SELECT symbol FROM aliases GROUP BY 1 HAVING count(*) >= 2 AND max(date) >= 20160101)""",
    "sectors": """SELECT concat('S', s_suppkey) AS symbol, s_name AS "longName", n_name AS sector
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 11 <> 10""",
    "muted": """SELECT chat_id, concat('S', s_suppkey) AS ticker, CAST(20240108 + s_suppkey % 5 AS INT) AS mute_end
FROM supplier, (SELECT unnest(['c1', 'c2']) AS chat_id) WHERE s_suppkey % 3 = 0 AND (chat_id = 'c1' OR s_suppkey % 2 = 0)""",
    "candidates": f"""
SELECT concat('S', l_suppkey) AS symbol, CAST(l_partkey % 5 + 1 AS INT) AS weeks,
  CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS opt_right,
  CAST(98000 + 1000*l_linenumber AS BIGINT) AS strike_milli,
  {EXPS}[CAST(l_partkey % 4 AS INT) + 1] AS exp_front, CAST(l_orderkey % 15 AS INT) AS bdte,
  l_linenumber + 5 AS "histEarningsCount", (l_suppkey + l_orderkey) % 9 / 8 - 0.5e0 AS pct_under_over_mean,
  CAST(l_quantity AS INT) AS ask_size_front, CAST(l_quantity + 3 AS INT) AS bid_size_front,
  CAST(60 - l_quantity AS INT) AS ask_size_back, CAST(62 - l_quantity AS INT) AS bid_size_back,
  l_discount * 4 AS "spreadPct_front", l_tax * 4 AS "spreadPct_back", l_discount * 7 AS "spreadPct_cal",
  l_extendedprice / 8192 AS "calCost", l_tax * 5 AS "calGapPct",
  (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 1024 / 8192 AS "undPricePctDiff",
  {fx.SNAPSHOT_EPOCH} + l_orderkey % 3 * 1800 AS "lastUpdated",
  l_suppkey % 32 / 16 AS undmean_avg_trade_class_combined_grade,
  {EXPS}[CAST((l_partkey + l_suppkey) % 4 AS INT) + 1] AS iv_max_exp_c,
  {EXPS}[CAST((l_partkey + l_orderkey) % 4 AS INT) + 1] AS iv_max_exp_p,
  (l_orderkey * 7 + l_partkey) % 101 / 100 AS prediction_score_1, l_orderkey * 8 + l_linenumber AS row_id
FROM lineitem""",
    "snap_log": f"""
SELECT concat('S', l_suppkey) AS symbol, CAST(l_partkey % 5 + 1 AS INT) AS weeks,
  {DAYS}[CAST(l_orderkey % 8 AS INT) + 1] AS trade_date, CAST(20240115 + l_suppkey % 9 AS INT) AS report_date,
  floor(l_extendedprice) / 8192 AS "calCostPct",
  CAST(l_quantity AS INT) AS ask_size_front, CAST(l_quantity + 3 AS INT) AS bid_size_front,
  CAST(60 - l_quantity AS INT) AS ask_size_back, CAST(62 - l_quantity AS INT) AS bid_size_back
FROM lineitem WHERE (l_suppkey + l_partkey % 5 + l_orderkey % 8) % 9 <> 0""",
    "alert_events": """
SELECT event_id, concat('S', user_id % 10) AS symbol, CAST(event_id % 5 + 1 AS INT) AS weeks,
  CAST(floor(epoch(ts)) AS BIGINT) AS alert_time, CAST(strftime(ts, '%Y%m%d') AS INT) AS alert_date
FROM events WHERE event_type = 'signup'""",
    "versions": """
SELECT event_id, user_id, value, CAST(floor(epoch(ts)) AS BIGINT) AS event_time,
  CAST(floor(floor(epoch(ts)) / 86400) * 86400 AS BIGINT) AS "lastUpdated" FROM events""",
}

# Tables with a name that also occurs as a column or alias are matched after
# FROM, JOIN or a comma only.
_USE = r"(?:\bFROM|\bJOIN|,)\s+{name}\b"


def uses(text: str) -> set[str]:
    return {n for n in CTES if re.search(_USE.format(name=n), text, re.IGNORECASE)}


def define(name: str, text: str) -> str:
    """Adds a derived table for later queries and returns its name."""
    CTES[name] = text
    return name


def with_tables(body: str) -> str:
    """The body preceded by every derived table it needs, dependencies first."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for dep in sorted(uses(CTES[name]) - {name}):
            visit(dep)
        needed.append(name)

    for name in sorted(uses(body)):
        visit(name)
    if not needed:
        return body
    tables = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    body = body.strip()
    recursive = ""
    if body.upper().startswith("WITH "):
        body = body[5:]
        if body.upper().startswith("RECURSIVE "):
            body, recursive = body[10:], "RECURSIVE "
        return f"WITH {recursive}{tables},\n{body}"
    return f"WITH {tables}\n{body}"
