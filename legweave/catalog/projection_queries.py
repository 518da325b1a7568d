"""Queries for prices and features (P*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.registry import query
from legweave.functions import dates as dt
from legweave.functions import labels as lb
from legweave.functions import pricing as pr
from legweave.operators import expirations as ex
from legweave.operators import legs, planning, trend
from legweave.operators.alerts import rounded
from legweave.plans.features import no_infinities
from legweave.plans.index_calendar import SNAPSHOT_SPAN_DAYS, both_rights
from legweave.skew import salted_join

PAIR_KEYS = ["symbol", "opt_right", "strike_milli", "trade_date"]

define(
    "pairs",
    """SELECT f.symbol, f.opt_right, f.strike_milli, f.trade_date, f.exp AS exp_front, b.exp AS exp_back,
  f.bid AS bid_front, f.ask AS ask_front, b.bid AS bid_back, b.ask AS ask_back,
  f.bid_size AS bid_size_front, f.ask_size AS ask_size_front, b.bid_size AS bid_size_back, b.ask_size AS ask_size_back,
  f.underlying AS underlying_front, b.underlying AS underlying_back,
  f.implied_vol AS implied_vol_front, b.implied_vol AS implied_vol_back,
  f.open_interest AS open_interest_front, b.open_interest AS open_interest_back
FROM chain f JOIN chain b ON f.symbol = b.symbol AND f.opt_right = b.opt_right AND f.strike_milli = b.strike_milli
  AND f.trade_date = b.trade_date AND f.exp < b.exp
  AND date_diff('day', strptime(CAST(f.exp AS VARCHAR), '%Y%m%d'), strptime(CAST(b.exp AS VARCHAR), '%Y%m%d')) + 1 <= 10""",
)
define(
    "wide",
    """SELECT p.symbol, p.strike_milli, p.trade_date, p.underlying, p.exp,
  p.bid AS "bid_P", p.ask AS "ask_P", p.bid_size AS "bid_size_P", p.ask_size AS "ask_size_P",
  p.implied_vol AS "implied_vol_P", p.delta AS "delta_P",
  c.bid AS "bid_C", c.ask AS "ask_C", c.bid_size AS "bid_size_C", c.ask_size AS "ask_size_C",
  c.implied_vol AS "implied_vol_C", c.delta AS "delta_C",
  CAST(floor((p.ms_of_day + c.ms_of_day) / 2) AS INT) AS ms_of_day
FROM (SELECT * FROM squotes JOIN sgreeks USING (symbol, opt_right, strike_milli, exp, trade_date) WHERE opt_right = 'P') p
JOIN (SELECT * FROM squotes JOIN sgreeks USING (symbol, opt_right, strike_milli, exp, trade_date) WHERE opt_right = 'C') c
  USING (symbol, strike_milli, trade_date, underlying, exp)""",
)


def chain_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return legs.front_back_pairs(fx.chain(spark, sf), PAIR_KEYS, SNAPSHOT_SPAN_DAYS)


def wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    return both_rights(fx.snapshot_greeks(spark, sf), fx.snapshot_quotes(spark, sf))


def round_sql(x: str, digits: int) -> str:
    """DuckDB text of ``round_half_even``."""
    f = f"{10**digits}e0"
    return f"round_even(({x}) * {f}, 0) / {f}"


IDS = "symbol, opt_right, strike_milli, exp, trade_date"


@query("p01_mark", f"SELECT {IDS}, (ask - bid) / 2 + bid AS mark FROM chain")
def p01(spark, sf):
    return fx.chain(spark, sf).select(*IDS.split(", "), pr.mark("bid", "ask").alias("mark"))


@query(
    "p02_leg_spread",
    f"""SELECT {IDS}, ask - bid AS spread_front,
      {round_sql('(ask - bid) / nullif((ask - bid) / 2 + bid, 0)', 2)} AS "spreadPct_front" FROM chain""",
)
def p02(spark, sf):
    named = fx.chain(spark, sf).withColumnsRenamed({"bid": "bid_front", "ask": "ask_front"})
    out = pr.with_leg_spread(named.withColumn("mark_front", pr.mark("bid_front", "ask_front")), "front")
    return out.select(*IDS.split(", "), "spread_front", "spreadPct_front")


def metric_sql(bid: str, ask: str, bid_b: str, ask_b: str, und: str, sfx: str, gap_ratio: bool = False) -> str:
    front, back = f"(({ask} - {bid}) / 2 + {bid})", f"(({ask_b} - {bid_b}) / 2 + {bid_b})"
    cost = f"({back} - {front})"
    ask_cal, bid_cal = f"({ask_b} - {bid})", f"({bid_b} - {ask})"
    spread = f"({ask_cal} - {bid_cal})"
    gap = f"{cost} / nullif({back}, 0)" if gap_ratio else f"{cost} - {back}"
    return f"""{cost} AS "calCost{sfx}", {cost} / nullif({und}, 0) * 100 AS "calCostPct{sfx}",
      {gap} AS "calGapPct{sfx}", {ask_cal} AS "ask_cal{sfx}", {bid_cal} AS "bid_cal{sfx}",
      {spread} AS "spread_cal{sfx}", {spread} / 2 + {bid_cal} AS "mark_cal{sfx}",
      {spread} / nullif({ask_cal}, 0) AS "spreadPct_cal{sfx}\""""


PAIR_IDS = "symbol, opt_right, strike_milli, trade_date, exp_front, exp_back"


@query(
    "p03_calendar_metrics",
    f"SELECT {PAIR_IDS}, {metric_sql('bid_front', 'ask_front', 'bid_back', 'ask_back', 'underlying_front', '')} FROM pairs",
)
def p03(spark, sf):
    c = F.col
    m = pr.calendar_metrics(c("bid_front"), c("ask_front"), c("bid_back"), c("ask_back"), c("underlying_front"))
    return chain_pairs(spark, sf).select(*PAIR_IDS.split(", "), *[v.alias(k) for k, v in m.items()])


@query(
    "p04_gap_index_and_ratio",
    f"""SELECT {PAIR_IDS}, ((ask_back - bid_back)/2 + bid_back - ((ask_front - bid_front)/2 + bid_front))
        - ((ask_back - bid_back)/2 + bid_back) AS gap_index,
      ((ask_back - bid_back)/2 + bid_back - ((ask_front - bid_front)/2 + bid_front))
        / nullif((ask_back - bid_back)/2 + bid_back, 0) AS gap_ratio FROM pairs""",
)
def p04(spark, sf):
    c = F.col
    pairs = chain_pairs(spark, sf).withColumn("underlying", c("underlying_front"))
    m = pr.calendar_metrics(c("bid_front"), c("ask_front"), c("bid_back"), c("ask_back"), c("underlying"))
    with_index = pairs.withColumn("gap_index", m["calGapPct"])
    return pr.equity_calendar_metrics(with_index).select(
        *PAIR_IDS.split(", "), "gap_index", c("calGapPct").alias("gap_ratio")
    )


@query(
    "p05_moneyness",
    f"""SELECT {IDS}, CAST(CAST((strike_milli / 1000 - underlying) / underlying AS FLOAT) AS DOUBLE) AS "undPricePctDiff" FROM chain""",
)
def p05(spark, sf):
    x = pr.moneyness("strike_milli", "underlying").cast("double")
    return fx.chain(spark, sf).select(*IDS.split(", "), x.alias("undPricePctDiff"))


@query(
    "p06_iv_front_back_diff",
    """SELECT f.symbol, f.opt_right, f.strike_milli, f.trade_date, f.ms_of_day, p.exp_front, p.exp_back, f.implied_vol AS iv_front,
      b.implied_vol AS iv_back,
      CAST(CAST(CASE WHEN f.implied_vol = 0 AND coalesce(b.implied_vol = 0, false) THEN 0
        WHEN f.implied_vol = 0 THEN 1 ELSE (f.implied_vol - b.implied_vol) / f.implied_vol END AS FLOAT) AS DOUBLE) AS iv_pct_diff
      FROM hist f JOIN (SELECT x.symbol, x.exp AS exp_front, y.exp AS exp_back FROM (SELECT DISTINCT symbol, exp FROM hist) x
        JOIN (SELECT DISTINCT symbol, exp FROM hist) y ON x.symbol = y.symbol AND x.exp < y.exp) p ON f.symbol = p.symbol AND f.exp = p.exp_front
      LEFT JOIN hist b ON b.symbol = f.symbol AND b.opt_right = f.opt_right AND b.strike_milli = f.strike_milli AND b.trade_date = f.trade_date
        AND b.ms_of_day = f.ms_of_day AND b.exp = p.exp_back""",
)
def p06(spark, sf):
    """Every pair of listed expirations; a front leg whose back leg has no bar keeps a null."""
    keys = ["symbol", "opt_right", "strike_milli", "trade_date", "ms_of_day"]
    h = fx.history(spark, sf).select(*keys, "exp", F.col("implied_vol").alias("iv"))
    pairs = ex.expiration_pairs(h)
    front, back = (legs.leg_scan(h, pairs, leg, "bars") for leg in legs.LEGS)
    both = legs.join_pair_legs(front, back, keys, "left")
    return both.withColumn("iv_pct_diff", pr.iv_front_back_diff("iv_front", "iv_back").cast("double"))


@query(
    "p07_strike_rescale",
    f"SELECT {IDS}, {round_sql('(strike_milli + bid_size * 5) / 1000', 2)} AS strike FROM chain",
)
def p07(spark, sf):
    """Strikes with half-cent ties, so the rounding rule shows."""
    x = pr.strike_price(F.col("strike_milli") + F.col("bid_size") * 5)
    return fx.chain(spark, sf).select(*IDS.split(", "), x.alias("strike"))


@query(
    "p08_strike_pct_from_underlying",
    f"SELECT {IDS}, {round_sql('(strike_milli / 1000 - underlying) / underlying', 3)} AS strike_pct_diff FROM chain",
)
def p08(spark, sf):
    x = pr.strike_pct_from_underlying(F.col("strike_milli") / 1000, "underlying")
    return fx.chain(spark, sf).select(*IDS.split(", "), x.alias("strike_pct_diff"))


@query(
    "p09_quarter_label",
    "SELECT o_orderkey, concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS \"rQuarter\" FROM orders",
)
def p09(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", dt.quarter_label(F.col("o_orderdate")).alias("rQuarter"))


@query(
    "p10_int_dates",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS day, CAST(strftime(o_orderdate + INTERVAL 7 DAY, '%Y%m%d') AS INT) AS week_later FROM orders",
)
def p10(spark, sf):
    days = fx.table(spark, sf, "orders").select("o_orderkey", dt.to_yyyymmdd("o_orderdate").alias("day"))
    return days.withColumn("week_later", dt.to_yyyymmdd(F.date_add(dt.to_day("day"), 7)))


def _cyc(name: str, angle: str) -> str:
    return f"round(cos({angle}), 9) AS cos_{name}, round(sin({angle}), 9) AS sin_{name}"


@query(
    "p11_cyclic_time_features",
    f"""SELECT o_orderkey, {_cyc('day', '2*pi()*dayofyear(o_orderdate)/365')}, {_cyc('month', '2*pi()*month(o_orderdate)/12')},
      {_cyc('weekday', '2*pi()*(isodow(o_orderdate) - 1)/7')}, CAST(year(o_orderdate) AS INT) AS year FROM orders""",
)
def p11(spark, sf):
    days = fx.table(spark, sf, "orders").select("o_orderkey", dt.to_yyyymmdd("o_orderdate").alias("day"))
    f = {k: (v if k == "year" else F.round(v, 9)) for k, v in dt.cyclic_time_features("day").items()}
    return days.withColumns(f).drop("day")


@query(
    "p12_trade_sizes",
    f"""SELECT {PAIR_IDS},
      CASE WHEN ask_size_front IS NOT NULL AND bid_size_back IS NOT NULL THEN least(ask_size_front, bid_size_back) END AS min_entry_size,
      greatest(ask_size_front, bid_size_back) AS max_entry_size,
      least(ask_size_back, bid_size_front) AS min_exit_size, greatest(ask_size_back, bid_size_front) AS max_exit_size
      FROM pairs""",
)
def p12(spark, sf):
    return trend.with_trade_sizes(chain_pairs(spark, sf)).select(
        *PAIR_IDS.split(", "), "min_entry_size", "max_entry_size", "min_exit_size", "max_exit_size"
    )


GAP_SQL = "CASE weeks WHEN 1 THEN 0.1e0 WHEN 2 THEN 0.175e0 WHEN 3 THEN 0.25e0 WHEN 4 THEN 0.325e0 WHEN 5 THEN 0.4e0 WHEN 6 THEN 0.475e0 END"


@query("p13_adjusted_gap", f'SELECT row_id, weeks, "calGapPct" - {GAP_SQL} AS "calGapPctAdjusted" FROM candidates')
def p13(spark, sf):
    return fx.candidates(spark, sf).select("row_id", "weeks", lb.adjusted_gap("calGapPct", "weeks").alias("calGapPctAdjusted"))


@query(
    "p14_finite_or_null",
    f"SELECT {IDS}, CASE WHEN open_interest = 1 THEN NULL ELSE implied_vol END AS implied_vol, CASE WHEN bid_size = 1 THEN NULL ELSE bid END AS bid FROM chain",
)
def p14(spark, sf):
    """Infinite and NaN values appear as null in every floating column."""
    dirty = fx.chain(spark, sf).select(
        *IDS.split(", "),
        F.when(F.col("open_interest") == 1, F.lit(float("inf"))).otherwise(F.col("implied_vol")).alias("implied_vol"),
        F.when(F.col("bid_size") == 1, F.lit(float("nan"))).otherwise(F.col("bid")).alias("bid"),
    )
    return no_infinities(dirty)


@query(
    "p15_grouped_rounding",
    f"""SELECT row_id, {round_sql('"calCost"', 3)} AS "calCost", {round_sql('"calGapPct"', 3)} AS "calGapPct",
      {round_sql('pct_under_over_mean', 3)} AS pct_under_over_mean, {round_sql('"spreadPct_front"', 2)} AS "spreadPct_front",
      {round_sql('"spreadPct_back"', 2)} AS "spreadPct_back", {round_sql('"spreadPct_cal"', 2)} AS "spreadPct_cal" FROM candidates""",
)
def p15(spark, sf):
    return rounded(fx.candidates(spark, sf)).select(
        "row_id", "calCost", "calGapPct", "pct_under_over_mean", "spreadPct_front", "spreadPct_back", "spreadPct_cal"
    )


@query(
    "p18_drop_by_substring",
    'SELECT symbol, strike_milli, trade_date, underlying, exp, "bid_size_P", "ask_size_P", "implied_vol_P", "delta_P", "bid_size_C", "ask_size_C", "implied_vol_C", "delta_C", ms_of_day FROM wide',
)
def p18(spark, sf):
    wide = wide_rows(spark, sf)
    return wide.select(*pr.columns_without(wide, ("bid_P", "ask_P", "bid_C", "ask_C")))


@query("p19_midpoint_time", "SELECT symbol, strike_milli, trade_date, exp, ms_of_day FROM wide")
def p19(spark, sf):
    return wide_rows(spark, sf).select("symbol", "strike_milli", "trade_date", "exp", "ms_of_day")


@query(
    "p20_leg_stamps",
    """SELECT c.symbol, opt_right, strike_milli, exp, trade_date, weeks, report_date, "noOfEsts", "epsForecast",
      "fiscalQuarterEnding", concat("fiscalQuarterEnding" // 10000, 'Q', ("fiscalQuarterEnding" // 100 % 100 + 2) // 3) AS "fQuarter", concat(report_date // 10000, 'Q', (report_date // 100 % 100 + 2) // 3) AS "rQuarter"
      FROM chain c JOIN earnings e ON c.symbol = e.symbol, (SELECT unnest([1, 2, 3]) AS weeks)""",
)
def p20(spark, sf):
    """Stamps travel on the planning rows through the join."""
    plan = planning.with_quarters(planning.for_weeks(fx.earnings(spark, sf), [1, 2, 3])).select(
        "symbol", "weeks", "report_date", "noOfEsts", "epsForecast", "fiscalQuarterEnding", "fQuarter", "rQuarter"
    )
    rows = fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "exp", "trade_date")
    return salted_join(rows, plan, ["symbol"])


@query(
    "p21_missing_open_interest",
    f"SELECT {IDS}, open_interest AS oi_snapshot, coalesce(open_interest, 0) AS oi_history FROM squotes LEFT JOIN soi USING ({IDS})",
)
def p21(spark, sf):
    joined = fx.snapshot_quotes(spark, sf).join(fx.snapshot_open_interest(spark, sf), IDS.split(", "), "left")
    return joined.select(*IDS.split(", "), F.col("open_interest").alias("oi_snapshot"), "open_interest").fillna(
        0, ["open_interest"]
    ).withColumnRenamed("open_interest", "oi_history")


@query(
    "p22_collapse_duplicates",
    "SELECT symbol, opt_right, strike_milli, trade_date, exp AS exp_front, underlying, bid, implied_vol FROM chain",
)
def p22(spark, sf):
    """Copies of expiration and underlying from two joined tables become one each."""
    q = fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "trade_date", "exp", "bid", "underlying")
    g = fx.snapshot_greeks(spark, sf).drop("ms_of_day", "delta")
    q = q.withColumnsRenamed({"exp": "exp_quotes_front", "underlying": "underlying_quotes_front"})
    g = g.withColumnsRenamed({"exp": "exp_greeks_front", "underlying": "underlying_greeks_front"})
    same = F.col("exp_quotes_front") == F.col("exp_greeks_front")
    joined = q.join(g, ["symbol", "opt_right", "strike_milli", "trade_date"]).filter(same)
    groups = {
        "exp_front": ["exp_greeks_front", "exp_quotes_front"],
        "underlying": ["underlying_greeks_front", "underlying_quotes_front"],
    }
    collapsed, _ = legs.collapse_duplicates(joined, groups)
    return collapsed


@query(
    "p23_alert_date",
    "SELECT event_id, CAST(strftime(timezone('America/New_York', timezone('UTC', make_timestamp(alert_time * 1000000))), '%Y%m%d') AS INT) AS alert_date FROM alert_events",
)
def p23(spark, sf):
    return fx.alert_events(spark, sf).select(
        "event_id", dt.epoch_to_local_day("alert_time", dt.EXCHANGE_ZONE).alias("alert_date")
    )


@query("p24_prediction_label", "SELECT row_id, CASE WHEN prediction_score_1 > 0.85e0 THEN 1 ELSE 0 END AS prediction_label FROM candidates")
def p24(spark, sf):
    return fx.candidates(spark, sf).select("row_id", lb.prediction_label("prediction_score_1").alias("prediction_label"))


@query(
    "p25_prediction_tier",
    """SELECT row_id, CASE WHEN prediction_score_1 > 0.95e0 THEN 'top' WHEN prediction_score_1 > 0.9e0 THEN 'high'
      WHEN prediction_score_1 > 0.75e0 THEN 'good' WHEN prediction_score_1 > 0.5e0 THEN 'fair'
      WHEN prediction_score_1 > 0 THEN 'weak' ELSE 'none' END AS tier FROM candidates""",
)
def p25(spark, sf):
    return fx.candidates(spark, sf).select("row_id", lb.score_tier("prediction_score_1").alias("tier"))


@query(
    "p26_iv_agreement",
    """SELECT row_id, CASE WHEN iv_max_exp_c = exp_front AND iv_max_exp_p = exp_front THEN 'High'
      WHEN iv_max_exp_c = exp_front THEN 'Medium (Calls)' WHEN iv_max_exp_p = exp_front THEN 'Medium (Puts)'
      ELSE 'Low' END AS agreement FROM candidates""",
)
def p26(spark, sf):
    c = F.col
    both = (c("iv_max_exp_c") == c("exp_front")) & (c("iv_max_exp_p") == c("exp_front"))
    return fx.candidates(spark, sf).select(
        "row_id", lb.iv_agreement(both, "iv_max_exp_c", "iv_max_exp_p", "exp_front").alias("agreement")
    )


@query(
    "p27_date_agreement",
    """SELECT symbol, CASE WHEN lower(replace(trim(comment), ' ', '')) IN ('samedate', 'sameweek', 'differentweek')
      THEN lower(replace(trim(comment), ' ', '')) ELSE 'default' END AS agreement FROM earnings""",
)
def p27(spark, sf):
    return fx.earnings(spark, sf).select("symbol", lb.date_agreement("comment").alias("agreement"))


@query(
    "p29_dataset_keys",
    """SELECT concat('calendar_C_', weeks, '_weeks/', symbol, '/', symbol, '_',
        concat("fiscalQuarterEnding" // 10000, 'Q', ("fiscalQuarterEnding" // 100 % 100 + 2) // 3)) AS filepath,
      concat(symbol, '_', report_date, '_', 20240119) AS exp_key
      FROM earnings, (SELECT unnest([1, 2, 3, 4, 5]) AS weeks)""",
)
def p29(spark, sf):
    plan = planning.with_quarters(planning.for_weeks(fx.earnings(spark, sf), fx.WEEKS))
    return plan.select(
        planning.dataset_key("C").alias("filepath"),
        planning.expirations_key("symbol", F.array("report_date", F.lit(20240119))).alias("exp_key"),
    )


@query(
    "p30_expected_price",
    """SELECT row_id, m / 100 * 100.5e0 AS "avgCalCost", ("calCost" - m) / m AS pct_under_over_mean,
      z - m AS "expectedCalCostPctDiff", z / 100 * 100.5e0 AS "expectedCalCost", greatest(z / 100 * 100.5e0, "calCost") AS "targetPrice",
      z / 100 * 100.5e0 - "calCost" AS "expectedProfit", (z / 100 * 100.5e0 - "calCost") / "calCost" AS "expectedProfitPct"
      FROM (SELECT *, weeks / 4 AS m, (bdte + 1) / 4 AS z FROM candidates)""",
)
def p30(spark, sf):
    """The columns that compare a calendar's cost with its history."""
    rows = fx.candidates(spark, sf).select(
        "row_id",
        "calCost",
        F.col("calCost").alias("calCostPct"),
        (F.col("weeks") / 4).alias("calCostPctMean"),
        ((F.col("bdte") + 1) / 4).alias("calCostPctMeanDayZero"),
        F.lit(100.5).alias("underlying"),
    )
    return pr.expected_price(rows).drop("calCost", "calCostPct", "calCostPctMean", "calCostPctMeanDayZero", "underlying")


