"""Queries for quality gates, the market layout, and jobs that store what they make."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave import market
from legweave.catalog.ctes import _history, define
from legweave.catalog.filter_queries import PRESET_SQL, day_sql
from legweave.catalog.job_queries import _NEAR, _OFF, _snapshot, index_run
from legweave.catalog.job_queries import multi_gap_run as multi_gap_bars
from legweave.catalog.model_queries import FIT_ROWS, NUMERIC, WEIGHTS
from legweave.catalog.projection_queries import GAP_SQL, round_sql
from legweave.catalog.registry import query
from legweave.catalog.source_queries import landed_by_day
from legweave.catalog.stream_queries import BAR_SQL, IVL_MS, _ticks
from legweave.operators import legs
from legweave.operators.enrich import with_sector
from legweave.plans import features as ft
from legweave.plans import models
from legweave.plans.equity_snapshot import snapshot_watch
from legweave.plans.index_history import DATASETS, HistoryStore, store_index_history
from legweave.plans.alert_run import read_alert_log, run_alerts
from legweave.plans.multi_gap import agreement_watch, multi_gap_run
from legweave.plans.scored_snapshot import ROW_KEYS, contract_watch, scored_snapshot, store_versions
from legweave.schemas import BAR_KEYS
from legweave.scratch import fresh_path, settle
from legweave.sinks import writers as wr
from legweave.sources import csv_scan, tables, ticks
from legweave.streaming import runner
from legweave.streaming.late import DELAY_SECONDS, LateBars

# ----------------------------------------------------------------------- gates


def gate_sql(name: str, broken: str, key: str, rows: str) -> str:
    """One line of a gate's report over ``rows``."""
    return f"""SELECT '{name}' AS gate, count(*) AS n_rows, count(*) FILTER (WHERE {broken}) AS n_broken,
  min(CASE WHEN {broken} THEN {key} END) AS first_key, max(CASE WHEN {broken} THEN {key} END) AS last_key FROM {rows}"""


define(
    "index_days",
    f"""SELECT symbol, trade_date, mean_price, greatest(abs(mean_price - lo), abs(mean_price - hi)) / nullif(mean_price, 0) AS deviation FROM (
  SELECT symbol, trade_date, {round_sql('avg(price)', 2)} AS mean_price, min(price) AS lo, max(price) AS hi FROM (
    SELECT symbol, trade_date, exp, arg_min({_OFF}, strike_milli) AS price FROM sgreeks WHERE {_NEAR} GROUP BY 1, 2, 3) GROUP BY 1, 2)""",
)


@query("f20_index_gates", gate_sql("price_disagreement", "NOT coalesce(deviation <= 0.0005e0, false)", "concat(symbol, '/', trade_date)", "index_days"))
def f20_index(spark, sf):
    """What the index job's gate has counted while the job ran."""
    run = index_run(spark, sf)
    return run.watch.table(spark)


@query("job_index_disagreements", "SELECT symbol, trade_date, mean_price, deviation FROM index_days WHERE NOT coalesce(deviation <= 0.0005e0, false)")
def index_disagreements(spark, sf):
    """The days that the index job leaves out, with their prices."""
    return index_run(spark, sf).disagreeing


define(
    "gap_prices",
    """SELECT symbol, exps, strike_milli, trade_date, ms_of_day, min(underlying) <> max(underlying) AS differs
FROM run_bars JOIN run_days USING (symbol, exps) JOIN run_range USING (symbol, exps) JOIN run_strikes USING (symbol, exps)
WHERE trade_date BETWEEN d0 AND d1 AND list_contains(ks, strike_milli) AND strike_milli / 1000 > lo * 0.94e0 AND strike_milli / 1000 < hi * 1.06e0
GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 8""",
)


@query("f20_multi_gap_gates", gate_sql("underlying_differs", "differs", "concat_ws('/', symbol, trade_date, ms_of_day, strike_milli)", "gap_prices"))
def f20_multi_gap(spark, sf):
    """Bars of the multi-gap job whose legs disagree about the underlying."""
    watch = agreement_watch()
    multi_gap_bars(spark, sf, watch)
    return watch.table(spark)


_SNAP_KEY = "concat_ws('/', symbol, weeks, trade_date, strike_milli)"
_SNAP_ROWS = """(SELECT *, count(*) OVER (PARTITION BY symbol, trade_date, weeks, opt_right, strike_milli) AS repeats,
  min(underlying) OVER d AS lo, max(underlying) OVER d AS hi FROM snapshot WINDOW d AS (PARTITION BY symbol, trade_date))"""
_SNAP_GATES = {
    "strike_repeats": "repeats > 1", "several_prices": "lo <> hi", "legs_out_of_order": "exp_front >= exp_back", "no_cost": '"calCost" IS NULL',
}


@query("f20_snapshot_gates", " UNION ALL ".join(gate_sql(n, broken, _SNAP_KEY, _SNAP_ROWS) for n, broken in _SNAP_GATES.items()))
def f20_snapshot(spark, sf):
    watch = snapshot_watch()
    settle(_snapshot(spark, sf, watch), "snapshot")
    return watch.table(spark)


# --------------------------------------------------------------- co-located legs

LEG_IDS = ["symbol", "opt_right", "strike_milli", "trade_date"]


def bucketed(spark, rows, kind, buckets):
    path = fresh_path(spark, f"bucketed-{kind}")
    return market.land_bucketed(rows, f"{kind}_{path[-32:]}", path, buckets)


def bucketed_history(spark, sf):
    """Quotes and greeks of the history, in as many buckets as its rows need."""
    rows = settle(fx.history(spark, sf), "history")
    buckets = market.buckets_for(rows.count())
    return bucketed(spark, fx.quotes_of(rows), "quotes", buckets), bucketed(spark, fx.greeks_of(rows), "greeks", buckets)


def co_located_quotes_greeks(quotes, greeks):
    return legs.join_quotes_greeks(quotes, greeks, BAR_KEYS)


@query(
    "j03_co_located_quotes_greeks",
    """SELECT symbol, opt_right, strike_milli, trade_date, exp, ms_of_day, q.bid AS bid_quote, g.bid AS bid_ivgreek, bid_size, implied_vol
      FROM quotes q JOIN greeks g USING (symbol, opt_right, strike_milli, trade_date, exp, ms_of_day)""",
)
def j03_bucketed(spark, sf):
    joined = co_located_quotes_greeks(*bucketed_history(spark, sf))
    out = joined.select(*LEG_IDS, "exp", "ms_of_day", "bid_quote", "bid_ivgreek", "bid_size", "implied_vol")
    with market.buckets_kept(spark):
        return settle(out, "joined")


def co_located_pairs(quotes):
    """Front and back legs of one bucketed table, all pairs of expirations within 45 days."""
    rows = quotes.select(*LEG_IDS, "ms_of_day", "exp", "bid")
    return legs.front_back_pairs(rows, [*LEG_IDS, "ms_of_day"], 45)


@query(
    "j02_co_located_legs",
    f"""SELECT symbol, opt_right, strike_milli, trade_date, ms_of_day, f.exp AS exp_front, b.exp AS exp_back, f.bid AS bid_front, b.bid AS bid_back
      FROM hist f JOIN hist b USING (symbol, opt_right, strike_milli, trade_date, ms_of_day)
      WHERE f.exp < b.exp AND date_diff('day', {day_sql('f.exp')}, {day_sql('b.exp')}) + 1 <= 45""",
)
def j02_bucketed(spark, sf):
    rows = settle(fx.quotes(spark, sf), "quotes")
    pairs = co_located_pairs(bucketed(spark, rows, "quotes", market.buckets_for(rows.count())))
    with market.buckets_kept(spark):
        return settle(pairs, "pairs")


def co_located_wide(quotes, greeks):
    """Puts and calls side by side in either table, then both tables."""
    keys = ["symbol", "strike_milli", "exp", "trade_date", "ms_of_day"]
    q = legs.widen_put_call(quotes.select(*keys, "opt_right", "bid"), keys)
    g = legs.widen_put_call(greeks.select(*keys, "opt_right", F.col("implied_vol").alias("iv")), keys)
    return q.join(g, keys)


@query(
    "j08_co_located_wide",
    """SELECT p.symbol, p.strike_milli, p.exp, p.trade_date, p.ms_of_day, p.bid AS "bid_P", c.bid AS "bid_C", g.implied_vol AS "iv_P", h.implied_vol AS "iv_C"
      FROM quotes p JOIN quotes c USING (symbol, strike_milli, exp, trade_date, ms_of_day) JOIN greeks g USING (symbol, strike_milli, exp, trade_date, ms_of_day)
      JOIN greeks h USING (symbol, strike_milli, exp, trade_date, ms_of_day)
      WHERE p.opt_right = 'P' AND c.opt_right = 'C' AND g.opt_right = 'P' AND h.opt_right = 'C'""",
)
def j08_bucketed(spark, sf):
    wide = co_located_wide(*bucketed_history(spark, sf))
    with market.buckets_kept(spark):
        return settle(wide, "wide")


# --------------------------------------------------------------- index history

# Some listings trade on their own expiration day; a symbol keeps three to six days of each.
FIRST_EXP, FIRST_RUN_DAY, LAST_DAY = 20240119, 20240108, 20240220
define(
    "index_bars",
    """SELECT * REPLACE (CASE WHEN trade_date = 20240111 AND open_interest > 1 THEN exp ELSE trade_date END AS trade_date) FROM hist""",
)
define("index_listing", "SELECT DISTINCT symbol, exp, trade_date FROM index_bars")
define(
    "index_wanted",
    f"""SELECT symbol, exp, trade_date FROM (SELECT l.*, CAST(substr(symbol, 2) AS INT) % 4 + 3 AS max_days,
    row_number() OVER (PARTITION BY symbol, exp ORDER BY trade_date DESC) AS nth FROM index_listing l
    SEMI JOIN (SELECT symbol, exp FROM index_listing WHERE exp = trade_date) own USING (symbol, exp) WHERE exp > {FIRST_EXP})
  WHERE nth <= max_days AND trade_date <= {LAST_DAY}""",
)
define("index_greeks", "SELECT * FROM index_bars WHERE open_interest > 1 OR bid_size > 3")
define("index_oi", "SELECT * FROM index_bars WHERE bid_size <= 30")
define(
    "index_whole",
    """SELECT symbol, exp, trade_date FROM (SELECT symbol, exp, trade_date, count(DISTINCT strike_milli) * 2 AS want FROM index_bars GROUP BY 1, 2, 3)
  JOIN (SELECT symbol, exp, trade_date, count(DISTINCT concat(strike_milli, opt_right)) AS have FROM index_greeks GROUP BY 1, 2, 3)
  USING (symbol, exp, trade_date) SEMI JOIN index_wanted USING (symbol, exp, trade_date) WHERE want = have""",
)


def _index_limits(spark, sf):
    """How many days each symbol keeps, for its old name too."""
    symbols = fx.table(spark, sf, "supplier").select(F.explode(F.array(*[F.concat(F.lit(p), "s_suppkey") for p in "SO"])).alias("symbol"))
    return symbols.withColumn("max_days", (F.substring("symbol", 2, 12).cast("int") % 4 + 3).cast("int"))


def index_history_runs(spark, sf):
    """Two runs into one store: the second finds later days, and what the first has left."""
    own_day = (F.col("trade_date") == 20240111) & (F.col("open_interest") > 1)
    bars = fx.history(spark, sf).withColumn("trade_date", F.when(own_day, F.col("exp")).otherwise(F.col("trade_date")))
    bars = landed_by_day(bars, "index-bars")
    market_tables = {
        "greeks": bars.filter((F.col("open_interest") > 1) | (F.col("bid_size") > 3)).drop("open_interest", "bid", "ask"),
        "open_interest": bars.filter(F.col("bid_size") <= 30).select(*BAR_KEYS, "open_interest"),
        "quotes": bars.select(*BAR_KEYS, "bid", "ask", "bid_size", "ask_size"),
    }
    store = HistoryStore(fresh_path(spark, "index-store"))
    days, limits = bars.select("symbol", "exp", "trade_date").distinct(), _index_limits(spark, sf)
    reports = [
        settle(store_index_history(spark, days, market_tables, limits, store, run, FIRST_EXP, last), "report")
        for run, last in ((1, FIRST_RUN_DAY), (2, LAST_DAY))
    ]
    return store, reports


@query(
    "job_index_history",
    """SELECT 'quotes' AS dataset, symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, bid AS value FROM index_bars SEMI JOIN index_whole USING (symbol, exp, trade_date)
      UNION ALL SELECT 'greeks', symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, implied_vol FROM index_greeks SEMI JOIN index_whole USING (symbol, exp, trade_date)
      UNION ALL SELECT 'open_interest', symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, CAST(open_interest AS DOUBLE) FROM index_oi SEMI JOIN index_whole USING (symbol, exp, trade_date)""",
)
def job_index_history(spark, sf):
    """The committed rows of all three datasets after two runs."""
    store, _ = index_history_runs(spark, sf)
    value = {"quotes": "bid", "greeks": "implied_vol", "open_interest": "open_interest"}
    parts = [
        store.rows(spark, d).select(F.lit(d).alias("dataset"), *BAR_KEYS, F.col(value[d]).cast("double").alias("value"))
        for d in DATASETS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "job_index_history_failures",
    """SELECT symbol, exp, trade_date, dataset, CASE WHEN trade_date <= 20240108 THEN 1 ELSE 2 END AS run
      FROM index_wanted ANTI JOIN index_whole USING (symbol, exp, trade_date), (SELECT unnest(['greeks', 'open_interest', 'quotes']) AS dataset)""",
)
def job_index_failures(spark, sf):
    """The ledger: units whose greeks were incomplete, by the run that found them."""
    store, _ = index_history_runs(spark, sf)
    return store.marks(spark, "failures").select("symbol", "exp", "trade_date", "dataset", F.col("run").cast("int").alias("run"))


@query(
    "job_index_history_report",
    """SELECT run, dataset, status, count(*) AS units FROM (
      SELECT symbol, exp, trade_date, dataset, run, CASE WHEN w.symbol IS NULL THEN 'failed' WHEN dataset = 'open_interest' AND o.symbol IS NULL THEN 'absent' ELSE 'committed' END AS status
      FROM (SELECT * FROM (SELECT *, CASE WHEN trade_date <= 20240108 THEN 1 ELSE 2 END AS first_run FROM index_wanted),
        (SELECT unnest([1, 2]) AS run), (SELECT unnest(['greeks', 'open_interest', 'quotes']) AS dataset))
      LEFT JOIN index_whole w USING (symbol, exp, trade_date) LEFT JOIN (SELECT DISTINCT symbol, exp, trade_date FROM index_oi) o USING (symbol, exp, trade_date)
      WHERE run = first_run OR (run = 2 AND first_run = 1 AND dataset = 'open_interest' AND w.symbol IS NOT NULL AND o.symbol IS NULL)) GROUP BY ALL""",
)
def job_index_report(spark, sf):
    """What each run found due: days of its own, and open interest that the first run missed."""
    _, reports = index_history_runs(spark, sf)
    both = [r.withColumn("run", F.lit(n)) for n, r in enumerate(reports, 1)]
    return both[0].unionByName(both[1]).groupBy("run", "dataset", "status").agg(F.count(F.lit(1)).alias("units"))


# ------------------------------------------------------------------- late ticks


def late_landings(spark, sf):
    """The events in three landings by time; one in seven of the first two comes with the last."""
    events = settle(fx.events(spark, sf), "events")
    at = F.unix_timestamp("ts")
    bounds = events.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))  # one row
    third = F.floor((at - F.col("lo")) * 3 / (F.col("hi") - F.col("lo") + 1))
    placed = events.crossJoin(F.broadcast(bounds)).withColumn("landing", third).drop("lo", "hi")
    return placed.withColumn("landing", F.when(F.col("event_id") % 7 == 3, 2).otherwise(F.col("landing")))


def late_bars(spark, sf):
    """The stream after each landing, then its corrections, twice."""
    landed = fresh_path(spark, "landed-events")
    placed = settle(late_landings(spark, sf), "landings")
    names = [c for c in placed.columns if c != "landing"]
    job = LateBars(spark, fresh_path(spark, "late-bars"), ["symbol"], "value", ["event_id"], IVL_MS)
    for n in range(3):
        placed.filter(F.col("landing") == n).select(*names).write.mode("append").parquet(landed)
        job.catch_up(_ticks(runner.stream_files(spark, landed, placed.select(*names).schema)))
        job.correct()
    job.correct()
    return job


@query(
    "x03_late_corrected_bars",
    BAR_SQL.format(s=IVL_MS // 1000) + f" WHERE bar_start + {IVL_MS // 1000} <= (SELECT floor(max(epoch(ts))) FROM events) - {DELAY_SECONDS}",
)
def x03_late(spark, sf):
    """Ticks out of order: the stream's bars and the rebuilt ones together equal the bars of all ticks."""
    return late_bars(spark, sf).bars()


# ----------------------------------------------------------------- stored models


def loads_logistic(content: bytes):
    """A scoring function from a file of weights."""
    weights = json.loads(content)

    def predict(pdf):
        z = sum(pdf[n].to_numpy(dtype="float64") * w for n, w in weights.items())
        return 1.0 / (1.0 + np.exp(-z))

    return predict


def fitted_pipeline(rows):
    """The small boosted-tree model of scored calendars, on a bounded sample."""
    stages = [
        StringIndexer(inputCol="sector", outputCol="sector_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=[*NUMERIC, "sector_idx"], outputCol="features", handleInvalid="keep"),
        GBTClassifier(labelCol="label", featuresCol="features", maxIter=3, maxDepth=3, seed=7),
    ]
    return Pipeline(stages=stages).fit(rows.orderBy(F.xxhash64("row_id"), "row_id").limit(FIT_ROWS))


@query("m03_stored_models", "SELECT row_id, true AS same_pipeline, true AS same_file FROM candidates SEMI JOIN sectors USING (symbol)")
def m03_stored(spark, sf):
    """Scores of the models read back, beside those of the models that were stored."""
    rows = with_sector(fx.candidates(spark, sf), fx.sectors(spark, sf)).withColumn(
        "label", F.when((F.col("calCost") < 4) & (F.col("calGapPct") < 0.2), 1.0).otherwise(0.0)
    )
    # A number of its own for every row: row_id may repeat.
    rows = settle(rows.withColumn("place", F.monotonically_increasing_id()), "scored-calendars")
    model, path, file = fitted_pipeline(rows), fresh_path(spark, "pipeline"), fresh_path(spark, "model-file")
    models.save_pipeline(model, path)
    content = json.dumps(WEIGHTS).encode()
    models.save_model_file(spark, content, file)
    score = "prediction_score_1"
    before = ft.score_with_model(rows, model).select("place", "row_id", F.col(score).alias("p"))
    after = ft.score_with_model(rows, models.load_pipeline(path)).select("place", F.col(score).alias("q"))
    direct = ft.score_with_function(rows, loads_logistic(content), list(WEIGHTS), ["place"]).select("place", F.col(score).alias("r"))
    stored = models.score_with_file(rows, file, loads_logistic, list(WEIGHTS), ["place"]).select("place", F.col(score).alias("s"))
    joined = before.join(after, "place").join(direct, "place").join(stored, "place")
    return joined.select("row_id", (F.col("p") == F.col("q")).alias("same_pipeline"), (F.col("r") == F.col("s")).alias("same_file"))


# ---------------------------------------------------------- replacing and rejecting


@query("k04_atomic_replace", "SELECT symbol, strike_milli, exp, opt_right, bid, 2 AS version FROM chain")
def k04_atomic(spark, sf):
    """A write that fails leaves readers with the version before it; the next one switches them."""
    rows = settle(fx.chain(spark, sf).select("symbol", "strike_milli", "exp", "opt_right", "bid"), "chain")
    root = fresh_path(spark, "versioned")
    name = "v_" + root[-32:]
    wr.replace_view(rows.withColumn("version", F.lit(1)), name, root)
    broken = rows.withColumn("version", F.raise_error(F.lit("a write that fails")).cast("int"))
    try:
        wr.replace_view(broken, name, root)
    except Exception:  # noqa: BLE001
        assert {r.version for r in spark.table(name).select("version").distinct().collect()} == {1}
    else:
        raise AssertionError("the broken write went through")
    halves = [rows.filter(F.col("opt_right") == r).withColumn("version", F.lit(2)) for r in ("C", "P")]
    wr.replace_by_union(halves, name, root)
    return tables.read_table(spark, table=name)


_LANDED = "symbol string, exp int, strike_milli bigint, trade_date int, bid double"


@query(
    "s05_rejected_rows",
    """SELECT symbol, count(*) FILTER (WHERE strike_milli % 5000 <> 0 AND exp <> 20240202) AS good,
      count(*) FILTER (WHERE strike_milli % 5000 = 0 OR exp = 20240202) AS rejected FROM chain GROUP BY 1""",
)
def s05_rejected(spark, sf):
    """Landed CSV with text for numbers and rows cut short: good rows arrive, the others are counted with their text."""
    bid = F.when(F.col("strike_milli") % 5000 == 0, "n/a").otherwise(F.col("bid").cast("string"))
    path = fresh_path(spark, "damaged-csv")
    rows = fx.chain(spark, sf).select("symbol", "exp", "strike_milli", "trade_date", bid.alias("bid"))
    short = F.col("exp") == 20240202
    wr.append_csv(rows.filter(~short), path)
    wr.append_csv(rows.filter(short).drop("bid"), path)
    schema = spark.createDataFrame([], _LANDED).schema
    good, rejected = csv_scan.read_bulk_csv_or_reject(spark, path, schema, ["symbol"])
    sides = good.select("symbol", F.lit(1).alias("ok")).unionByName(
        rejected.select(F.substring_index("rejected", ",", 1).alias("symbol"), F.lit(0).alias("ok"))
    )
    return sides.groupBy("symbol").agg(F.count_if(F.col("ok") == 1).alias("good"), F.count_if(F.col("ok") == 0).alias("rejected"))


@query(
    "s01_rejected_pages",
    """SELECT symbol, count(*) FILTER (WHERE exp <> 20240126) AS good_rows, count(DISTINCT CASE WHEN exp = 20240126 THEN trade_date END) AS rejected_pages
      FROM chain GROUP BY 1""",
)
def s01_rejected(spark, sf):
    """Tick pages of which some were cut off while they were landed."""
    chain = fx.chain(spark, sf)
    names = ["root", "expiration", "strike", "date", "bid"]
    values = [F.col(c).cast("string") for c in ("symbol", "exp", "strike_milli", "trade_date", "bid")]
    pages = chain.groupBy("symbol", "exp", "trade_date").agg(F.collect_list(F.array(*values)).alias("response"))
    header = F.struct(F.array(*[F.lit(n) for n in names]).alias("format"))
    text = F.to_json(F.struct(header.alias("header"), "response"))
    cut = F.when(F.col("exp") == 20240126, F.concat(F.lit("{\"root\":\""), "symbol", F.lit("\",\"res"))).otherwise(text)
    path = fresh_path(spark, "damaged-pages")
    pages.select(cut.alias("value")).write.text(path)
    good, rejected = ticks.read_pages_or_reject(spark, path)
    rows = ticks.flatten_pages(good, {"root": "string", "bid": "double"}, contract=False).select("symbol", F.lit(1).alias("ok"))
    lost = rejected.select(F.regexp_extract("rejected", '"root":"([^"]*)"', 1).alias("symbol"), F.lit(0).alias("ok"))
    both = rows.unionByName(lost)
    return both.groupBy("symbol").agg(F.count_if(F.col("ok") == 1).alias("good_rows"), F.count_if(F.col("ok") == 0).alias("rejected_pages"))


# ----------------------------------------------------------- the snapshot's tail

NEWER, OLDER = 1_707_000_000, 1_703_000_000
MODEL_WEIGHTS = {"calCost": -0.25, "calGapPctAdjusted": 1.5, "bdte": 0.0625, "weeks": 0.5, "underlying": 0.03125, "pre_0_avg": -0.125}


def tail_run(spark, sf, version, watch=None):
    """The snapshot of every date and its scored rows, with all inputs of the model in the frame."""
    snapshot = settle(_snapshot(spark, sf), "snapshot")
    frame = ft.feature_frame(snapshot, fx.sectors(spark, sf), fx.backtest_aggs(spark, sf), fx.snapshot_log(spark, sf), fx.HOLIDAYS)
    frame = fx.with_model_columns(frame, ft.missing_features(frame))
    content = json.dumps(MODEL_WEIGHTS).encode()

    def score(rows):
        return ft.score_with_function(rows, loads_logistic(content), list(MODEL_WEIGHTS), ROW_KEYS)

    return scored_snapshot(snapshot, frame, score, version, watch)


define(
    "model_frame",
    f"""SELECT *, "calGapPct" - {GAP_SQL} AS "calGapPctAdjusted" FROM snapshot SEMI JOIN sectors USING (symbol)
  SEMI JOIN (SELECT symbol, CAST(weeks AS INT) AS weeks, bdte FROM aggs WHERE latest) a USING (symbol, weeks, bdte) JOIN snap_slices USING (symbol, weeks, bdte)""",
)
_LOGIT = " + ".join(f'"{n}" * ({w}e0)' for n, w in MODEL_WEIGHTS.items())


@query(
    "job_scored_snapshot",
    f"""SELECT s.symbol, s.weeks, s.trade_date, s.exp_front, s.strike_milli, s."calCost", round(p, 9) AS prediction_score_1, round(1 - p, 9) AS prediction_score_0,
      CASE WHEN p > 0.85e0 THEN 1 WHEN p IS NOT NULL THEN 0 END AS prediction_label, {NEWER} AS "lastUpdated"
      FROM snapshot s LEFT JOIN (SELECT symbol, weeks, trade_date, exp_front, strike, 1 / (1 + exp(-({_LOGIT}))) AS p FROM model_frame) f
      USING (symbol, weeks, trade_date, exp_front, strike)""",
)
def job_scored(spark, sf):
    """Two versions are stored, the newer one twice; retention leaves it alone, once."""
    path = fresh_path(spark, "scored-snapshots")
    rows = settle(tail_run(spark, sf, OLDER), "scored")
    store_versions(spark, rows, path, OLDER)
    for _ in range(2):
        store_versions(spark, wr.stamp_version(rows, NEWER), path, NEWER)
    left = spark.read.parquet(path)
    scores = [F.round(f"prediction_score_{i}", 9).alias(f"prediction_score_{i}") for i in (0, 1)]
    names = ["symbol", "weeks", "trade_date", "exp_front", "strike_milli", "calCost"]
    return left.select(*names, *scores, "prediction_label", F.col("lastUpdated").cast("long").alias("lastUpdated"))


_CONTRACT = ", ".join(f"('{n}')" for n in ft.MODEL_FEATURES)


@query(
    "m04_contract_nulls",
    f"""SELECT concat('null_', name) AS gate, count(*) AS n_rows, count(*) FILTER (WHERE CASE WHEN starts_with(name, 'iv_error') THEN strike_milli % 2000 = 0
      WHEN name = 'spreadPct_cal' THEN "spreadPct_cal" IS NULL ELSE false END) AS n_broken FROM model_frame, (VALUES {_CONTRACT}) f(name) GROUP BY 1""",
)
def m04_contract(spark, sf):
    """Nulls of every model input, counted while the rows were scored."""
    watch = contract_watch()
    settle(tail_run(spark, sf, NEWER, watch), "scored")
    return watch.table(spark).select("gate", "n_rows", "n_broken")


# ------------------------------------------------------------ work that is left

MG_FIRST, MG_LAST = 20240102, 20240212
define("week", _history(7, 1))
define(
    "mg_inside",
    f"""SELECT * REPLACE (underlying + CASE WHEN opt_right = 'C' AND strike_milli % 2000 = 0 THEN 0.5e0 ELSE 0e0 END AS underlying) FROM week WHERE trade_date > {MG_FIRST} AND trade_date < {MG_LAST} AND exp < {MG_LAST}""",
)
define(
    "mg_units",
    f"""SELECT symbol, concat_ws('_', symbol, {', '.join(str(e) for e in fx.EXPIRATIONS)}) AS filepath, min(trade_date) AS d0, max(trade_date) AS d1 FROM (
  SELECT symbol, trade_date FROM mg_inside GROUP BY 1, 2 HAVING count(DISTINCT exp) = 4) GROUP BY 1 HAVING count(*) >= 5""",
)
define("mg_left", "SELECT * FROM mg_units WHERE symbol NOT LIKE '%4'")
define(
    "mg_strikes",
    """SELECT symbol, strike_milli, row_number() OVER (PARTITION BY symbol ORDER BY strike_milli) AS place, count(*) OVER (PARTITION BY symbol) AS n
FROM (SELECT symbol, strike_milli FROM mg_inside GROUP BY 1, 2 HAVING count(DISTINCT exp) = 4)""",
)
define(
    "mg_rows",
    f"""SELECT symbol, filepath, strike_milli, trade_date, ms_of_day FROM mg_inside JOIN mg_left USING (symbol) JOIN mg_strikes USING (symbol, strike_milli)
  JOIN (SELECT symbol, min(underlying) AS lo, max(underlying) AS hi FROM mg_inside JOIN mg_left USING (symbol)
    JOIN (SELECT symbol, strike_milli FROM mg_strikes WHERE place = n // 2 + 1) m USING (symbol, strike_milli)
    WHERE exp = {fx.EXPIRATIONS[0]} AND opt_right = 'C' AND underlying <> 0 AND trade_date BETWEEN d0 AND d1 GROUP BY 1) USING (symbol)
  WHERE trade_date BETWEEN d0 AND d1 AND strike_milli / 1000 > lo * 0.94e0 AND strike_milli / 1000 < hi * 1.06e0
  GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 8""",
)
define("mg_dated", "SELECT * FROM mg_rows SEMI JOIN (SELECT filepath FROM mg_rows GROUP BY 1 HAVING count(DISTINCT trade_date) > 5) USING (filepath)")


@query(
    "job_multi_gap_run",
    """SELECT filepath, 'stored' AS status, count(*) AS n_rows FROM mg_dated GROUP BY 1
      UNION ALL SELECT filepath, 'failed', 0 FROM mg_left WHERE filepath NOT IN (SELECT filepath FROM mg_dated)""",
)
def multi_gap_left(spark, sf):
    """A run within its dates that skips the units of some symbols as done, and tells which of the others gave nothing."""
    d = landed_by_day(fx.history(spark, sf, 7, 1), "daily")
    odd = (F.col("opt_right") == "C") & (F.col("strike_milli") % 2000 == 0)
    price = F.col("underlying") + F.when(odd, 0.5).otherwise(0.0)
    done = d.filter(F.col("symbol").endswith("4")).select(
        F.concat_ws("_", "symbol", *[F.lit(str(e)) for e in fx.EXPIRATIONS]).alias("filepath")
    )
    run = multi_gap_run(d.select(*BAR_KEYS, "bid", "ask"), d.select(*BAR_KEYS, "implied_vol", price.alias("underlying")), done.distinct(), MG_FIRST, MG_LAST)
    stored = run.rows.groupBy("filepath").agg(F.lit("stored").alias("status"), F.count(F.lit(1)).alias("n_rows"))
    return stored.unionByName(run.failures.select("filepath", F.lit("failed").alias("status"), F.lit(0).cast("long").alias("n_rows")))


@query(
    "job_alert_log",
    f"""SELECT symbol, weeks, min("lastUpdated") AS alert_time FROM (
      SELECT * REPLACE ({round_sql('"calCost"', 3)} AS "calCost", {round_sql('"calGapPct"', 3)} AS "calGapPct",
        {round_sql('pct_under_over_mean', 3)} AS pct_under_over_mean, {round_sql('"spreadPct_front"', 2)} AS "spreadPct_front",
        {round_sql('"spreadPct_back"', 2)} AS "spreadPct_back", {round_sql('"spreadPct_cal"', 2)} AS "spreadPct_cal") FROM candidates
      WHERE undmean_avg_trade_class_combined_grade >= 1.25e0) WHERE {PRESET_SQL} AND "calGapPct" < {GAP_SQL} GROUP BY 1, 2""",
)
def job_alert_log(spark, sf):
    """Three runs half an hour apart, the second one twice: within the hour a key is logged by the first that has it."""
    scored = settle(fx.candidates(spark, sf), "scored")
    log = fresh_path(spark, "alert-log")
    for run in (0, 1, 1, 2):
        run_alerts(spark, scored.filter(F.col("lastUpdated") == fx.SNAPSHOT_EPOCH + 1800 * run), log, run)
    return read_alert_log(spark, log).select("symbol", "weeks", "alert_time")
