"""Queries for joins (J*) and set operations (U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.filter_queries import cols, day_sql
from legweave.catalog.projection_queries import round_sql, wide_rows
from legweave.catalog.registry import query
from legweave.operators import enrich, expirations as ex, ivchain, legs, planning
from legweave.operators.trend import TREND_MEASURES
from legweave.plans.features import scores_back, snapshot_trend, trend_slice
from legweave.schemas import BAR_KEYS, CONTRACT_KEYS
from legweave.skew import salted_join

LEG_IDS = "symbol, opt_right, strike_milli, trade_date"


@query(
    "j01_front_back_snapshot",
    f"""SELECT {LEG_IDS}, f.bid AS bid_front, f.ask AS ask_front, f.exp AS exp_front, b.bid AS bid_back, b.ask AS ask_back, b.exp AS exp_back
      FROM chain f JOIN chain b USING ({LEG_IDS}) WHERE f.exp < b.exp""",
)
def j01(spark, sf):
    """The legs of every pair of listed expirations."""
    q = fx.chain(spark, sf).select(*cols(LEG_IDS), "exp", "bid", "ask")
    pairs = ex.expiration_pairs(q)
    return legs.join_pair_legs(*[legs.leg_scan(q, pairs, leg, "quotes") for leg in legs.LEGS])


@query(
    "j02_front_back_history",
    f"""SELECT {LEG_IDS}, ms_of_day, f.bid AS bid_front, b.bid AS bid_back, f.exp AS exp_front, b.exp AS exp_back
      FROM hist f JOIN hist b USING ({LEG_IDS}, ms_of_day) WHERE f.exp < b.exp""",
)
def j02(spark, sf):
    q = fx.history(spark, sf).select(*cols(LEG_IDS), "ms_of_day", "exp", "bid")
    pairs = ex.expiration_pairs(q)
    front, back = (legs.leg_scan(q, pairs, leg, "bars") for leg in legs.LEGS)
    return legs.join_pair_legs(front, back, legs.HISTORY_LEG_KEYS)


@query(
    "j03_quotes_greeks",
    f"""SELECT {LEG_IDS}, exp, ms_of_day, q.bid AS bid_quote, g.bid AS bid_ivgreek, bid_size, implied_vol
      FROM quotes q JOIN greeks g USING ({LEG_IDS}, exp, ms_of_day)""",
)
def j03(spark, sf):
    joined = legs.join_quotes_greeks(fx.quotes(spark, sf), fx.greeks(spark, sf), BAR_KEYS)
    return joined.select(*cols(LEG_IDS), "exp", "ms_of_day", "bid_quote", "bid_ivgreek", "bid_size", "implied_vol")


@query(
    "j04_open_interest",
    f"""SELECT {LEG_IDS}, p.exp_front, p.exp_back, f.open_interest AS open_interest_front, b.open_interest AS open_interest_back
      FROM pairs p LEFT JOIN soi f ON p.symbol = f.symbol AND p.opt_right = f.opt_right AND p.strike_milli = f.strike_milli
        AND p.trade_date = f.trade_date AND p.exp_front = f.exp
      LEFT JOIN soi b ON p.symbol = b.symbol AND p.opt_right = b.opt_right AND p.strike_milli = b.strike_milli
        AND p.trade_date = b.trade_date AND p.exp_back = b.exp""".replace("SELECT symbol, opt_right, strike_milli, trade_date", "SELECT p.symbol, p.opt_right, p.strike_milli, p.trade_date"),
)
def j04(spark, sf):
    q = fx.chain(spark, sf).select(*cols(LEG_IDS), "exp")
    pairs = legs.front_back_pairs(q, cols(LEG_IDS), 10)
    oi = fx.snapshot_open_interest(spark, sf)
    return legs.join_open_interest(pairs, oi, oi, cols(LEG_IDS))


@query(
    "j05_greeks_quotes_per_expiration",
    f"SELECT {LEG_IDS}, exp, bid, ask, delta, implied_vol, underlying FROM squotes JOIN sgreeks USING ({LEG_IDS}, exp)",
)
def j05(spark, sf):
    return legs.merge(fx.snapshot_greeks(spark, sf), fx.snapshot_quotes(spark, sf), CONTRACT_KEYS).select(
        *cols(LEG_IDS), "exp", "bid", "ask", "delta", "implied_vol", "underlying"
    )


@query("j06_put_call_widening", "SELECT * FROM wide")
def j06(spark, sf):
    return wide_rows(spark, sf)


@query(
    "j06_put_call_join",
    """SELECT symbol, strike_milli, trade_date, exp, ms_of_day, p.bid AS "bid_P", c.bid AS "bid_C"
      FROM (SELECT * FROM hist WHERE opt_right = 'P') p JOIN (SELECT * FROM hist WHERE opt_right = 'C') c USING (symbol, strike_milli, trade_date, exp, ms_of_day)""",
)
def j06_join(spark, sf):
    """The join form, for tables whose keys may repeat."""
    rows = fx.history(spark, sf).select("symbol", "strike_milli", "trade_date", "exp", "opt_right", "ms_of_day", "bid")
    return legs.join_put_call(rows, ["symbol", "strike_milli", "trade_date", "exp", "ms_of_day"])


FOLD_KEYS = "symbol, trade_date, ms_of_day, strike_milli, opt_right"


def _legs_sql(value: str) -> str:
    parts = []
    for i, e in enumerate(fx.EXPIRATIONS):
        parts.append(f"(SELECT {FOLD_KEYS}, {value} AS v{i}, exp AS e{i} FROM daily WHERE exp = {e}) l{i}")
    joined = parts[0] + "".join(f" JOIN {p} USING ({FOLD_KEYS})" for p in parts[1:])
    return joined


LEG_NAMES = ["front", "back_G1", "back_G2", "back_G3"]


@query(
    "j07_fold_legs",
    f"SELECT {FOLD_KEYS}, {', '.join(f'v{i} AS "bid_{n}", e{i} AS "exp_{n}"' for i, n in enumerate(LEG_NAMES))} FROM {_legs_sql('bid')}",
)
def j07(spark, sf):
    rows = fx.daily(spark, sf).select(*cols(FOLD_KEYS), "exp", "bid")
    parts = {n: rows.filter(F.col("exp") == e) for n, e in zip(LEG_NAMES, fx.EXPIRATIONS)}
    return legs.fold_legs(parts, cols(FOLD_KEYS))


@query(
    "j07_widen_legs",
    f"SELECT {FOLD_KEYS}, {', '.join(f'v{i} AS "bid_{n}"' for i, n in enumerate(LEG_NAMES))} FROM {_legs_sql('bid')}",
)
def j07_widen(spark, sf):
    """The same legs side by side by one aggregation."""
    which = F.create_map(*[x for e, n in zip(fx.EXPIRATIONS, LEG_NAMES) for x in (F.lit(e), F.lit(n))])
    rows = fx.daily(spark, sf).withColumn("leg", F.element_at(which, F.col("exp")))
    return legs.widen_legs(rows, cols(FOLD_KEYS), "leg", LEG_NAMES, ["bid"])


@query(
    "j08_wide_greeks_quotes",
    """SELECT q.symbol, q.exp, q.trade_date, q.ms_of_day, q.strike_milli, q."bid_P", q."bid_C", g."iv_P", g."iv_C" FROM
      (SELECT p.symbol, p.exp, p.trade_date, p.ms_of_day, p.strike_milli, p.bid AS "bid_P", c.bid AS "bid_C" FROM daily p JOIN daily c
        ON p.symbol = c.symbol AND p.trade_date = c.trade_date AND p.ms_of_day = c.ms_of_day AND p.strike_milli = c.strike_milli
        AND p.exp = c.exp WHERE p.opt_right = 'P' AND c.opt_right = 'C') q JOIN
      (SELECT p.symbol, p.exp, p.trade_date, p.ms_of_day, p.strike_milli, p.implied_vol AS "iv_P", c.implied_vol AS "iv_C" FROM daily p JOIN daily c
        ON p.symbol = c.symbol AND p.trade_date = c.trade_date AND p.ms_of_day = c.ms_of_day AND p.strike_milli = c.strike_milli
        AND p.exp = c.exp WHERE p.opt_right = 'P' AND c.opt_right = 'C') g
      USING (symbol, exp, trade_date, ms_of_day, strike_milli)""",
)
def j08(spark, sf):
    keys = ["symbol", "exp", "trade_date", "ms_of_day", "strike_milli"]
    bars = fx.daily(spark, sf)
    q = legs.widen_put_call(bars.select(*keys, "opt_right", "bid"), keys)
    g = legs.widen_put_call(bars.select(*keys, "opt_right", F.col("implied_vol").alias("iv")), keys)
    return q.join(g, keys)


@query(
    "j09_calendar_pairs",
    f"SELECT {LEG_IDS}, exp_front, exp_back, bid_front, bid_back, implied_vol_front, implied_vol_back FROM pairs",
)
def j09(spark, sf):
    rows = fx.chain(spark, sf).select(*cols(LEG_IDS), "exp", "bid", "implied_vol")
    return legs.front_back_pairs(rows, cols(LEG_IDS), 10)


@query(
    "j09_recovery_pairs",
    f"""SELECT symbol, opt_right, strike_milli, trade_date, f.exp AS exp, b.exp AS "exp_G1", f.bid AS bid, b.bid AS "bid_G1", ms_of_day
      FROM hist f JOIN hist b USING (symbol, opt_right, strike_milli, trade_date, ms_of_day)
      WHERE f.exp < b.exp AND date_diff('day', {day_sql('f.exp')}, {day_sql('b.exp')}) + 1 <= 45
        AND date_diff('day', DATE '2024-01-08', {day_sql('f.exp')}) + 1 <= 20""",
)
def j09_recovery(spark, sf):
    rows = fx.history(spark, sf).select("symbol", "opt_right", "strike_milli", "trade_date", "ms_of_day", "exp", "bid")
    keys = ["symbol", "opt_right", "strike_milli", "trade_date", "ms_of_day"]
    return legs.calendar_pairs(rows, keys, 45, max_front_days=20, from_day=20240108)


# Expiration choice, one step per table.
define("listed", "SELECT DISTINCT symbol, exp FROM chain")
define(
    "fronts",
    """SELECT e.symbol, e.report_date, min(exp) AS exp_front FROM earnings e JOIN listed l
       ON e.symbol = l.symbol AND l.exp >= e.report_date GROUP BY 1, 2""",
)
define(
    "tries",
    f"""SELECT f.symbol, f.report_date, f.exp_front, w AS weeks, prio,
  CAST(strftime({day_sql('f.exp_front')} + INTERVAL 1 DAY * (7 * w + off), '%Y%m%d') AS INT) AS exp_back
FROM fronts f, (SELECT unnest([1, 2, 3]) AS w), (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2), (5, 3), (6, -3)) AS o(prio, off)""",
)
define(
    "chosen",
    f"""SELECT t.symbol, t.report_date, t.weeks, t.exp_front, arg_min(t.exp_back, prio) AS exp_back
FROM tries t JOIN listed l ON t.symbol = l.symbol AND t.exp_back = l.exp AND t.exp_back >= t.report_date
WHERE date_diff('day', {day_sql('t.report_date')}, {day_sql('t.exp_front')}) < 7 GROUP BY 1, 2, 3, 4""",
)


def _plan(spark, sf):
    return planning.for_weeks(fx.earnings(spark, sf).select("symbol", "report_date"), [1, 2, 3])


@query("j10_front_expiration", "SELECT symbol, report_date, exp_front FROM fronts")
def j10(spark, sf):
    lists = ex.expiration_lists(fx.chain(spark, sf))
    rows = salted_join(fx.earnings(spark, sf).select("symbol", "report_date"), lists, ["symbol"])
    return rows.select(
        "symbol", "report_date", ex.first_expiration_from("expirations", "report_date").alias("exp_front")
    ).filter(F.col("exp_front").isNotNull())


@query("j11_back_expiration", "SELECT symbol, report_date, weeks, exp_front, exp_back FROM chosen")
def j11(spark, sf):
    return ex.choose_expirations(_plan(spark, sf), ex.expiration_lists(fx.chain(spark, sf)))


@query(
    "j12_semi_join_symbols",
    "SELECT symbol, strike_milli, exp, trade_date, opt_right FROM chain WHERE symbol IN (SELECT symbol FROM sectors)",
)
def j12(spark, sf):
    rows = fx.chain(spark, sf).select("symbol", "strike_milli", "exp", "trade_date", "opt_right")
    return enrich.in_symbols(rows, fx.sectors(spark, sf))


@query(
    "j13_skip_existing",
    """SELECT symbol, exp, trade_date, dataset FROM (SELECT DISTINCT symbol, exp, trade_date FROM hist),
        (SELECT unnest(['greeks', 'open_interest', 'quotes']) AS dataset)
      EXCEPT SELECT symbol, exp, trade_date, 'greeks' FROM greeks
      EXCEPT SELECT symbol, exp, trade_date, 'open_interest' FROM oi WHERE trade_date < 20240109""",
)
def j13(spark, sf):
    """Which datasets of each (expiration, day) are still to be written."""
    keys = ["symbol", "exp", "trade_date"]
    done = (
        fx.greeks(spark, sf).select(*keys, F.lit("greeks").alias("dataset"))
        .unionByName(
            fx.open_interest(spark, sf).filter(F.col("trade_date") < 20240109).select(*keys, F.lit("open_interest").alias("dataset"))
        )
    )
    return planning.due_slices(fx.history(spark, sf), done, ["greeks", "open_interest", "quotes"])


@query(
    "j14_skip_failed",
    """SELECT filepath FROM (SELECT concat('calendar_C_', weeks, '_weeks/', symbol, '/', symbol, '_',
        concat("fiscalQuarterEnding" // 10000, 'Q', ("fiscalQuarterEnding" // 100 % 100 + 2) // 3)) AS filepath, dte
      FROM earnings, (SELECT unnest([1, 2, 3]) AS weeks)) WHERE dte > 4 OR NOT contains(filepath, '_2_weeks')""",
)
def j14(spark, sf):
    plan = planning.with_quarters(planning.for_weeks(fx.earnings(spark, sf), [1, 2, 3])).withColumn(
        "filepath", planning.dataset_key("C")
    )
    failed = plan.filter((F.col("weeks") == 2) & (F.col("dte") <= 4)).select("filepath")
    return planning.not_in(plan, failed, ["filepath"]).select("filepath")


define(
    "plan_grades",
    """SELECT symbol, CAST(weeks AS INT) AS weeks, "targetFiscalQuarter", "Grade", undmean_avg_trade_class_combined_grade,
  all_avg_trade_class_combined_grade, overmean_avg_trade_class_combined_grade FROM grades
WHERE weeks <> 'Average' AND latest AND weeks <= '5'
  AND symbol IN (SELECT symbol FROM grades GROUP BY symbol HAVING max(undmean_avg_trade_class_combined_grade) >= 1.25e0)""",
)
define("near_earnings", 'SELECT * FROM earnings WHERE bdte <= 20')


@query(
    "j15_grades_earnings",
    'SELECT symbol, weeks, "Grade", undmean_avg_trade_class_combined_grade, report_date, dte, "noOfEsts" FROM plan_grades JOIN near_earnings USING (symbol)',
)
def j15(spark, sf):
    earnings = enrich.upcoming(fx.earnings(spark, sf))
    return enrich.grades_with_earnings(enrich.plan_grades(fx.grades(spark, sf)), earnings).select(
        "symbol", "weeks", "Grade", "undmean_avg_trade_class_combined_grade", "report_date", "dte", "noOfEsts"
    )


CAND = ["row_id", "symbol", "weeks", "calCost"]


@query(
    "j16_earnings_and_grades",
    """SELECT row_id, symbol, c.weeks, "calCost", "noOfEsts", "epsForecast", e.bdte, e.dte, "Grade",
      undmean_avg_trade_class_combined_grade FROM (SELECT row_id, symbol, weeks, "calCost" FROM candidates) c
      JOIN earnings e USING (symbol) JOIN plan_grades g USING (symbol, weeks)""",
)
def j16(spark, sf):
    joined = enrich.with_earnings_and_grades(
        fx.candidates(spark, sf).select(*CAND), fx.earnings(spark, sf), enrich.plan_grades(fx.grades(spark, sf))
    )
    return joined.select(
        *CAND, "noOfEsts", "epsForecast", "bdte", "dte", "Grade", "undmean_avg_trade_class_combined_grade"
    )


define(
    "stats",
    f"""SELECT symbol, bdte, CAST(weeks AS INT) AS weeks, {round_sql('"calCostPctMean"', 4)} AS "calCostPctMean", "calCostPctStd",
  "calCostPctMax", "calCostPctMin", "histEarningsCount", "histCalCostCount" FROM cost_stats WHERE latest""",
)


@query(
    "j17_cost_history",
    """SELECT row_id, c.symbol, c.weeks, "calCost", c.bdte, z."calCostPctMean" AS "calCostPctMeanDayZero", s."calCostPctMean",
      s."histCalCostCount" FROM candidates c JOIN stats z ON c.symbol = z.symbol AND c.weeks = z.weeks AND z.bdte = 1
      JOIN stats s ON c.symbol = s.symbol AND c.weeks = s.weeks AND c.bdte = s.bdte""",
)
def j17(spark, sf):
    rows = fx.candidates(spark, sf).select(*CAND, "bdte")
    joined = enrich.with_cost_stats(rows, enrich.latest_cost_stats(fx.cost_stats(spark, sf)))
    return joined.select(*CAND, "bdte", "calCostPctMeanDayZero", "calCostPctMean", "histCalCostCount")


@query("j18_sector", "SELECT row_id, symbol, sector FROM candidates JOIN sectors USING (symbol)")
def j18(spark, sf):
    return enrich.with_sector(fx.candidates(spark, sf).select("row_id", "symbol"), fx.sectors(spark, sf))


@query(
    "j19_historical_grade",
    """SELECT 'latest' AS mode, row_id, symbol, c.weeks, all_avg_trade_class_combined_grade AS all_grade FROM
        (SELECT row_id, symbol, weeks FROM candidates) c JOIN (SELECT symbol, CAST(CASE WHEN weeks = 'Average' THEN '0' ELSE weeks END AS INT) AS weeks,
          all_avg_trade_class_combined_grade FROM grades WHERE latest AND weeks <> 'Average') g USING (symbol, weeks)
      UNION ALL SELECT 'quarter', row_id, symbol, c.weeks, all_avg_trade_class_combined_grade FROM
        (SELECT row_id, symbol, weeks, CASE WHEN bdte % 2 = 0 THEN '2023Q3' ELSE '2023Q4' END AS q FROM candidates) c
        JOIN (SELECT symbol, CAST(CASE WHEN weeks = 'Average' THEN '0' ELSE weeks END AS INT) AS weeks, "targetFiscalQuarter" AS q,
          all_avg_trade_class_combined_grade FROM grades WHERE weeks <> 'Average') g USING (symbol, weeks, q)""",
)
def j19(spark, sf):
    rows = fx.candidates(spark, sf).select("row_id", "symbol", "weeks", "bdte", "undmean_avg_trade_class_combined_grade")
    quarter = F.when(F.col("bdte") % 2 == 0, "2023Q3").otherwise("2023Q4")
    grades = fx.grades(spark, sf)
    out = [F.lit("latest").alias("mode"), "row_id", "symbol", "weeks", F.col("all_avg_trade_class_combined_grade").alias("all_grade")]
    by_latest = enrich.with_historical_grade(rows, grades, latest=True).select(*out)
    plain = rows.drop("undmean_avg_trade_class_combined_grade").withColumn("fQuarter", quarter)
    by_quarter = enrich.with_historical_grade(plain, grades, latest=False)
    return by_latest.unionByName(by_quarter.select(F.lit("quarter").alias("mode"), *out[1:]))


@query(
    "j20_backtest_aggregates",
    """SELECT row_id, symbol, c.weeks, c.bdte, all_pl_pct_mean, all_total_trades, all_win_rate, undmean_pl_pct_mean, overmean_pl_pct_mean
      FROM (SELECT row_id, symbol, weeks, bdte FROM candidates) c JOIN (SELECT * EXCLUDE (weeks), CAST(weeks AS INT) AS weeks FROM aggs WHERE latest) a
      USING (symbol, weeks, bdte)""",
)
def j20(spark, sf):
    rows = fx.candidates(spark, sf).select("row_id", "symbol", "weeks", "bdte")
    return enrich.with_backtest_aggs(rows, fx.backtest_aggs(spark, sf), latest=True)


TREND_SQL = """SELECT symbol, weeks, t.idx - f.idx AS bdte, round(stddev_samp("calCostPct"), 9) AS "stddev", max("calCostPct") AS "max",
  min("calCostPct") AS "min", avg("calCostPct") AS "avg", count("calCostPct") AS "count",
  avg(least(ask_size_front, bid_size_back)) AS min_entry_size_mean, avg(greatest(ask_size_front, bid_size_back)) AS max_entry_size_mean,
  avg(least(ask_size_back, bid_size_front)) AS min_exit_size_mean, avg(greatest(ask_size_back, bid_size_front)) AS max_exit_size_mean,
  round(avg("calCostPct") + stddev_samp("calCostPct"), 9) AS upper_ci, round(avg("calCostPct") - stddev_samp("calCostPct"), 9) AS lower_ci
FROM snap_log JOIN cal f ON trade_date = f.day JOIN cal t ON report_date = t.day GROUP BY 1, 2, 3"""
define("trend", TREND_SQL)

define(
    "slices",
    "SELECT symbol, weeks, b AS bdte, "
    + ", ".join(
        f'max(CASE WHEN place = {i + 1} THEN "{m}" END) AS "pre_{i}_{m}"' for i in range(3) for m in TREND_MEASURES
    )
    + """ FROM (SELECT w.bdte AS b, t.*, t.bdte - w.bdte AS off, row_number() OVER (PARTITION BY w.symbol, w.weeks, w.bdte ORDER BY t.bdte) AS place
  FROM (SELECT DISTINCT symbol, weeks, bdte FROM candidates) w JOIN trend t ON w.symbol = t.symbol AND w.weeks = t.weeks
  AND t.bdte BETWEEN w.bdte AND w.bdte + 3 AND t."count" > 4)
GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE off <= 2) = 3 OR count(*) FILTER (WHERE off >= 1) = 3""",
)


def rounded_trend(df):
    return df.withColumns({n: F.round(n, 9) for n in df.columns if any(x in n for x in ("stddev", "_ci"))})


@query(
    "j21_trend_features",
    "SELECT row_id, symbol, weeks, bdte, pre_0_avg, pre_1_avg, pre_2_max, pre_2_count FROM candidates JOIN slices USING (symbol, weeks, bdte)",
)
def j21(spark, sf):
    rows = fx.candidates(spark, sf).select("row_id", "symbol", "weeks", "bdte")
    slices = trend_slice(rows, snapshot_trend(fx.snapshot_log(spark, sf), fx.HOLIDAYS))
    return salted_join(rows, slices, ["symbol", "weeks", "bdte"]).select(
        "row_id", "symbol", "weeks", "bdte", "pre_0_avg", "pre_1_avg", "pre_2_max", "pre_2_count"
    )


define(
    "scored",
    """SELECT symbol, strike_milli / 1000 AS strike, opt_right, exp_front, weeks, max(prediction_score_1) AS prediction_score_1
FROM candidates WHERE bdte > 3 GROUP BY 1, 2, 3, 4, 5""",
)


@query(
    "j22_scores_back",
    """SELECT row_id, c.symbol, s.prediction_score_1, 1 - s.prediction_score_1 AS prediction_score_0,
      CASE WHEN s.prediction_score_1 IS NULL THEN NULL WHEN s.prediction_score_1 > 0.85e0 THEN 1 ELSE 0 END AS prediction_label
      FROM candidates c LEFT JOIN scored s ON c.symbol = s.symbol AND c.strike_milli / 1000 = s.strike AND c.opt_right = s.opt_right
      AND c.exp_front = s.exp_front AND c.weeks = s.weeks""",
)
def j22(spark, sf):
    rows = fx.candidates(spark, sf).withColumn("strike", F.col("strike_milli") / 1000)
    keys = ["symbol", "strike", "opt_right", "exp_front", "weeks"]
    scored = (
        rows.filter(F.col("bdte") > 3)
        .groupBy(*keys)
        .agg(F.max("prediction_score_1").alias("prediction_score_1"))
        .withColumns(
            {
                "prediction_score_0": 1 - F.col("prediction_score_1"),
                "prediction_label": F.when(F.col("prediction_score_1") > 0.85, 1).otherwise(0),
            }
        )
    )
    return scores_back(rows.drop("prediction_score_1"), scored).select(
        "row_id", "symbol", "prediction_score_1", "prediction_score_0", "prediction_label"
    )


define(
    "peaks",
    """SELECT symbol, trade_date, max(CASE WHEN opt_right = 'C' THEN exp END) AS iv_max_exp_c, max(CASE WHEN opt_right = 'P' THEN exp END) AS iv_max_exp_p
FROM (SELECT symbol, trade_date, opt_right, exp, row_number() OVER (PARTITION BY symbol, trade_date, opt_right ORDER BY implied_vol DESC, exp DESC) AS place FROM sgreeks
      WHERE implied_vol IS NOT NULL) WHERE place = 1 GROUP BY symbol, trade_date""",
)


@query(
    "j23_iv_peak",
    """SELECT row_id, symbol, iv_max_exp_c, iv_max_exp_p, coalesce(iv_max_exp_c = iv_max_exp_p, false) AS iv_pc_max_same,
      coalesce(iv_max_exp_c = exp_front, false) AS iv_fexp_c, coalesce(iv_max_exp_p = exp_front, false) AS iv_fexp_p,
      coalesce(iv_max_exp_c = exp_front, false) AND coalesce(iv_max_exp_p = exp_front, false) AS iv_consensus
      FROM (SELECT row_id, symbol, exp_front, CAST(20240108 + row_id // 8 % 4 AS INT) AS trade_date FROM candidates) JOIN peaks USING (symbol, trade_date)""",
)
def j23(spark, sf):
    peaks = ivchain.peaks_by_right(ivchain.peak_expirations(fx.snapshot_greeks(spark, sf)))
    day = (F.lit(20240108) + F.floor(F.col("row_id") / 8) % 4).cast("int")
    rows = fx.candidates(spark, sf).select("row_id", "symbol", "exp_front", day.alias("trade_date"))
    return ivchain.with_iv_flags(rows, peaks).drop("exp_front", "trade_date")


@query(
    "j24_earnings_comment",
    """SELECT row_id, c.symbol, comment, "sourceUsed" FROM (SELECT row_id, CASE WHEN row_id % 9 = 0 THEN concat('N', symbol) ELSE symbol END AS symbol FROM candidates) c
      LEFT JOIN earnings e ON c.symbol = e.symbol""",
)
def j24(spark, sf):
    """Some candidates have no report; a symbol with two reports has a row for each."""
    unknown = F.when(F.col("row_id") % 9 == 0, F.concat(F.lit("N"), "symbol")).otherwise(F.col("symbol"))
    return enrich.with_comment(fx.candidates(spark, sf).select("row_id", unknown.alias("symbol")), fx.earnings(spark, sf))


@query(
    "j25_symbol_aliases",
    """SELECT r.symbol, r.root, report_date, n > 1 AS several FROM earnings e JOIN roots r ON e.symbol = r.root
      JOIN (SELECT symbol, count(DISTINCT root) AS n FROM roots WHERE root IN (SELECT symbol FROM earnings) GROUP BY 1) k ON r.symbol = k.symbol""",
)
def j25(spark, sf):
    symbols = fx.earnings(spark, sf).select("symbol", "report_date")
    rows = planning.rows_of_roots(symbols, planning.symbol_roots(symbols, planning.active_symbols(fx.aliases(spark, sf))))
    flagged = planning.several_roots(rows).select("symbol", F.lit(True).alias("several"))
    return salted_join(rows, flagged, ["symbol"], "left").select(
        "symbol", "root", "report_date", F.coalesce("several", F.lit(False)).alias("several")
    )


@query(
    "j26_plan_by_weeks",
    "SELECT symbol, report_date, weeks FROM earnings, (SELECT unnest([1, 2, 3, 4, 5]) AS weeks)",
)
def j26(spark, sf):
    return planning.for_weeks(fx.earnings(spark, sf).select("symbol", "report_date"), fx.WEEKS)


@query(
    "j27_leg_product",
    f"""SELECT symbol, opt_right, dataset, leg, exp FROM (SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY exp) - 1 AS INT) AS leg, exp FROM listed),
      (SELECT unnest(['P', 'C']) AS opt_right), (SELECT unnest(['greeks', 'quotes']) AS dataset)""",
)
def j27(spark, sf):
    lists = ex.expiration_lists(fx.chain(spark, sf))
    return planning.leg_product(lists, ["P", "C"], ["greeks", "quotes"], "expirations").drop("expirations")


# ------------------------------------------------------------ set operations


@query(
    "u01_two_leg_intersection",
    """SELECT f.symbol, f.exp AS exp_front, b.exp AS exp_back,
      (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT unnest(list_intersect(f.d, b.d)) AS x)) AS trade_dates
      FROM (SELECT symbol, exp, list(DISTINCT trade_date) AS d FROM chain GROUP BY 1, 2) f
      JOIN (SELECT symbol, exp, list(DISTINCT trade_date) AS d FROM chain GROUP BY 1, 2) b ON f.symbol = b.symbol
      WHERE f.exp < b.exp AND len(list_intersect(f.d, b.d)) >= 1""",
)
def u01(spark, sf):
    rows = fx.chain(spark, sf)
    common = ex.common_listing(ex.expiration_pairs(rows), ex.contract_listing(rows), 1)
    return common.select(
        "symbol", "exp_front", "exp_back", F.concat_ws(",", F.array_sort("trade_dates").cast("array<string>")).alias("trade_dates")
    )


@query(
    "u02_n_way_intersection",
    """SELECT symbol, trade_date, strike_milli FROM (SELECT DISTINCT symbol, trade_date, strike_milli, exp FROM quotes)
      GROUP BY 1, 2, 3 HAVING count(*) = 4""",
)
def u02(spark, sf):
    """Strikes that trade in all four expirations of a day."""
    return ex.in_all_groups(fx.quotes(spark, sf), ["symbol", "trade_date"], "strike_milli", "exp", 4)


@query(
    "u03_union_all",
    "SELECT symbol, exp, strike_milli, bid FROM chain WHERE opt_right = 'C' UNION ALL SELECT symbol, exp, strike_milli, bid FROM daily WHERE opt_right = 'P'",
)
def u03(spark, sf):
    names = ["symbol", "exp", "strike_milli", "bid"]
    a = fx.chain(spark, sf).filter(F.col("opt_right") == "C").select(*names)
    return a.unionByName(fx.daily(spark, sf).filter(F.col("opt_right") == "P").select(*reversed(names)))


@query("u04_distinct", "SELECT DISTINCT symbol, weeks, bdte FROM candidates")
def u04(spark, sf):
    return fx.candidates(spark, sf).select("symbol", "weeks", "bdte").distinct()


@query(
    "u05_difference",
    "SELECT symbol, exp, trade_date FROM (SELECT DISTINCT symbol, exp, trade_date FROM hist) EXCEPT SELECT symbol, exp, trade_date FROM oi WHERE open_interest > 1",
)
def u05(spark, sf):
    keys = ["symbol", "exp", "trade_date"]
    done = fx.open_interest(spark, sf).filter(F.col("open_interest") > 1).select(*keys).distinct()
    return planning.not_in(fx.history(spark, sf).select(*keys).distinct(), done, keys)


