"""Queries for sources (S*) and sinks (K*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.registry import query
from legweave.functions.dates import to_day
from legweave.operators import expirations as ex
from legweave.operators.filters import complete_slices
from legweave.operators.legs import join_pair_legs, leg_scan
from legweave.operators.planning import not_in, rows_of_roots, symbol_roots, values_of_roots
from legweave.operators.typeplan import apply_types, plan_types
from legweave.schemas import QUOTE_TYPES
from legweave.scratch import fresh_path, settle
from legweave.sinks import writers as wr
from legweave.sources import csv_scan, scans, tables, ticks

# ---------------------------------------------------------------- landed JSON

# Header names of the tick service.
TICK_NAMES = ["ms_of_day", "bid", "ask", "implied_vol", "underlying_price", "date"]


def _text(name: str):
    return F.col(name).cast("string")


def write_tick_pages(rows: DataFrame, path: str) -> None:
    """Lands a chain as tick pages, one per symbol, expiration and date.

    Calls come as contract objects with two ticks (only the first counts); the
    header of odd dates lists the names in another order.
    """
    straight = [F.lit(fx.OPEN_MS).cast("string"), _text("bid"), _text("ask"), _text("implied_vol"), _text("underlying"), _text("trade_date")]
    odd = F.col("trade_date") % 2 == 1
    names = F.when(odd, F.array(*[F.lit(n) for n in reversed(TICK_NAMES)])).otherwise(
        F.array(*[F.lit(n) for n in TICK_NAMES])
    )
    values = F.when(odd, F.array(*reversed(straight))).otherwise(F.array(*straight))
    second = F.transform(values, lambda v: F.lit("0"))
    item = F.struct(
        F.struct(
            F.col("symbol").alias("root"),
            F.col("exp").alias("expiration"),
            F.col("strike_milli").alias("strike"),
            F.col("opt_right").alias("right"),
        ).alias("contract"),
        F.array(values, second).alias("ticks"),
    )
    pages = (
        rows.select("symbol", "exp", "trade_date", names.alias("names"), item.alias("item"))
        .groupBy("symbol", "exp", "trade_date", "names")
        .agg(F.collect_list("item").alias("response"))
    )
    pages.select(F.struct(F.col("names").alias("format")).alias("header"), "response").write.json(path)


TICK_FIELDS = {
    "ms_of_day": "int",
    "bid": "double",
    "ask": "double",
    "implied_vol": "double",
    "underlying_price": "double",
    "date": "int",
}


@query(
    "s01_tick_json_flatten",
    f"""SELECT symbol, exp, strike_milli, opt_right,
      {fx.OPEN_MS} AS ms_of_day, bid, ask, implied_vol, underlying, trade_date FROM chain""",
)
def s01(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "tick-pages")
    write_tick_pages(fx.chain(spark, sf), path)
    return ticks.flatten_pages(ticks.read_pages(spark, path), TICK_FIELDS)


@query(
    "s02_page_union",
    """SELECT symbol, bid, ask, trade_date FROM chain WHERE opt_right = 'C' UNION ALL
       SELECT symbol, bid, ask, trade_date FROM chain WHERE opt_right = 'P'""",
)
def s02(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of two requests below one folder, each with its own header, in one scan."""
    root = fresh_path(spark, "page-folders")
    chain = fx.chain(spark, sf)
    for right in ("C", "P"):
        write_tick_pages(chain.filter(F.col("opt_right") == right), f"{root}/{right}")
    pages = ticks.read_pages(spark, f"{root}/*")
    return ticks.flatten_pages(pages, TICK_FIELDS).select("symbol", "bid", "ask", "trade_date")


# ------------------------------------------------------------- several roots


def _roots(spark: SparkSession, sf: str) -> DataFrame:
    symbols = fx.earnings(spark, sf).select("symbol")
    return symbol_roots(symbols, fx.aliases(spark, sf))


@query(
    "s03_multi_root_union",
    """SELECT r.symbol, r.root, opt_right, strike_milli, exp, trade_date, bid, ask
       FROM chain q JOIN roots r ON q.symbol = r.root""",
)
def s03(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of_roots(
        fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "bid", "ask"),
        _roots(spark, sf),
    )


@query(
    "s04_multi_root_list",
    """SELECT symbol, string_agg(exp, ',' ORDER BY exp) AS exps FROM (
         SELECT DISTINCT r.symbol, exp FROM quotes q JOIN roots r ON q.symbol = r.root) GROUP BY symbol""",
)
def s04(spark: SparkSession, sf: str) -> DataFrame:
    lists = values_of_roots(fx.quotes(spark, sf), _roots(spark, sf), "exp")
    return lists.select("symbol", F.concat_ws(",", F.col("exps").cast("array<string>")).alias("exps"))


# ------------------------------------------------------------------ bulk CSV

# Header names of the bulk files.
CSV_COLUMNS = [
    "root", "expiration", "strike", "right", "ms_of_day", "bid_size", "bid_condition", "bid_exchange", "bid",
    "ask_size", "ask_condition", "ask_exchange", "ask", "date",
]


def write_bulk_csv(rows: DataFrame, path: str) -> None:
    vendor = rows.withColumnsRenamed(
        {"symbol": "root", "exp": "expiration", "strike_milli": "strike", "opt_right": "right", "trade_date": "date"}
    )
    vendor.select(*CSV_COLUMNS).write.option("header", True).csv(path)


def _landed_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "bulk-csv")
    write_bulk_csv(fx.quotes(spark, sf), path)
    return csv_scan.read_bulk_csv(spark, path, CSV_COLUMNS)


@query(
    "s05_bulk_csv_scan",
    """SELECT symbol AS root, CAST(exp AS VARCHAR) AS expiration, CAST(strike_milli AS VARCHAR) AS strike,
      opt_right AS "right", CAST(ms_of_day AS VARCHAR) AS ms_of_day, CAST(bid_size AS VARCHAR) AS bid_size,
      CAST(ask_size AS VARCHAR) AS ask_size, CAST(trade_date AS VARCHAR) AS date FROM quotes""",
)
def s05(spark: SparkSession, sf: str) -> DataFrame:
    return _landed_csv(spark, sf).select(
        "root", "expiration", "strike", "right", "ms_of_day", "bid_size", "ask_size", "date"
    )


@query("s06_expirations_of_root", "SELECT DISTINCT symbol, exp FROM quotes")
def s06(spark: SparkSession, sf: str) -> DataFrame:
    return ex.expirations_of(fx.quotes(spark, sf))


@query(
    "s07_trading_days_of_expiration",
    """SELECT symbol, exp, string_agg(trade_date, ',' ORDER BY trade_date) AS trade_dates
       FROM (SELECT DISTINCT symbol, exp, trade_date FROM quotes) GROUP BY 1, 2""",
)
def s07(spark: SparkSession, sf: str) -> DataFrame:
    days = ex.trading_days_of(fx.quotes(spark, sf))
    return days.withColumn("trade_dates", F.concat_ws(",", F.col("trade_dates").cast("array<string>")))


@query(
    "s08_strikes_of_expiration",
    """SELECT symbol, exp, string_agg(strike_milli, ',' ORDER BY strike_milli) AS strikes
       FROM (SELECT DISTINCT symbol, exp, strike_milli FROM quotes) GROUP BY 1, 2""",
)
def s08(spark: SparkSession, sf: str) -> DataFrame:
    strikes = ex.strikes_of(fx.quotes(spark, sf))
    return strikes.withColumn("strikes", F.concat_ws(",", F.col("strikes").cast("array<string>")))


@query("s09_root_listing", "SELECT DISTINCT symbol FROM quotes")
def s09(spark: SparkSession, sf: str) -> DataFrame:
    return fx.quotes(spark, sf).select("symbol").distinct()


# --------------------------------------------------------------------- scans


@query(
    "s10_greeks_scan",
    """SELECT symbol, opt_right, strike_milli, exp, trade_date, delta, theta, vega, implied_vol, underlying
       FROM greeks WHERE opt_right = 'C'""",
)
def s10(spark: SparkSession, sf: str) -> DataFrame:
    return scans.scan_greeks(fx.greeks(spark, sf), "C")


@query(
    "s11_quote_scan",
    """SELECT symbol, opt_right, strike_milli, exp, trade_date, ms_of_day, bid_size, bid, ask_size, ask,
      (ask - bid)/2 + bid AS mark FROM quotes""",
)
def s11(spark: SparkSession, sf: str) -> DataFrame:
    return scans.scan_quotes(fx.quotes(spark, sf), "PC")


@query("s12_open_interest_scan", "SELECT symbol, opt_right, strike_milli, exp, open_interest FROM oi WHERE opt_right = 'P'")
def s12(spark: SparkSession, sf: str) -> DataFrame:
    return scans.scan_open_interest(fx.open_interest(spark, sf), "P")


def landed_by_day(rows: DataFrame, name: str) -> DataFrame:
    """Rows landed with a partition per trade date, and read back."""
    path = fresh_path(rows.sparkSession, name)
    wr.write_partitioned(rows, path, ["trade_date"])
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per symbol, strike and right: a front expiration and two to four days."""
    chain = fx.chain(spark, sf)
    return chain.groupBy("symbol", "strike_milli", "opt_right").agg(
        F.min("exp").alias("exp"),
        F.lit(20240103).alias("start_date"),
        (F.lit(20240104) + F.min("bid_size") % 3 * 2).cast("int").alias("end_date"),
    )


REQUESTS = """(SELECT symbol, strike_milli, opt_right, min(exp) AS exp, 20240103 AS start_date,
  20240104 + min(bid_size) % 3 * 2 AS end_date FROM chain GROUP BY 1, 2, 3)"""


@query(
    "s13_history_slices",
    f"""SELECT 'greeks' AS kind, g.symbol, g.opt_right, g.strike_milli, g.exp, trade_date, ms_of_day, implied_vol AS value
      FROM greeks g JOIN {REQUESTS} r ON g.symbol = r.symbol AND g.exp = r.exp AND g.strike_milli = r.strike_milli
      AND g.opt_right = r.opt_right AND trade_date BETWEEN start_date AND end_date
    UNION ALL SELECT 'quotes', g.symbol, g.opt_right, g.strike_milli, g.exp, trade_date, ms_of_day, bid
      FROM quotes g JOIN {REQUESTS} r ON g.symbol = r.symbol AND g.exp = r.exp AND g.strike_milli = r.strike_milli
      AND g.opt_right = r.opt_right AND trade_date BETWEEN start_date AND end_date
    UNION ALL SELECT 'oi', g.symbol, g.opt_right, g.strike_milli, g.exp, trade_date, ms_of_day, CAST(open_interest AS DOUBLE)
      FROM oi g JOIN {REQUESTS} r ON g.symbol = r.symbol AND g.exp = r.exp AND g.strike_milli = r.strike_milli
      AND g.opt_right = r.opt_right AND trade_date BETWEEN start_date AND end_date""",
)
def s13(spark: SparkSession, sf: str) -> DataFrame:
    """The requests prune the landed history to their days while it is read."""
    requests = settle(_requests(spark, sf), "requests")
    landed = landed_by_day(fx.history(spark, sf), "history")
    parts = []
    for kind, rows, value in (
        ("greeks", fx.greeks_of(landed), "implied_vol"),
        ("quotes", fx.quotes_of(landed), "bid"),
        ("oi", fx.open_interest_of(landed), "open_interest"),
    ):
        hits = scans.history_slices(rows, requests)
        parts.append(
            hits.select(
                F.lit(kind).alias("kind"), "symbol", "opt_right", "strike_milli", "exp", "trade_date", "ms_of_day",
                F.col(value).cast("double").alias("value"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "s14_complete_slices",
    """SELECT symbol, exp, trade_date, opt_right, strike_milli, ms_of_day, implied_vol
       FROM greeks g SEMI JOIN (
         SELECT w.symbol, w.exp, w.trade_date FROM
           (SELECT symbol, exp, trade_date, count(DISTINCT strike_milli) * 2 AS want FROM quotes GROUP BY 1, 2, 3) w
           JOIN (SELECT symbol, exp, trade_date, count(DISTINCT concat(strike_milli, opt_right)) AS have
                 FROM greeks GROUP BY 1, 2, 3) h
           ON w.symbol = h.symbol AND w.exp = h.exp AND w.trade_date = h.trade_date AND want = have) c
       ON g.symbol = c.symbol AND g.exp = c.exp AND g.trade_date = c.trade_date""",
)
def s14(spark: SparkSession, sf: str) -> DataFrame:
    kept = complete_slices(fx.greeks(spark, sf), fx.quotes(spark, sf), ["symbol", "exp", "trade_date"])
    return kept.select("symbol", "exp", "trade_date", "opt_right", "strike_milli", "ms_of_day", "implied_vol")


@query(
    "s15_snapshot_bulk_scans",
    """SELECT q.symbol, q.opt_right, q.strike_milli, q.exp, q.trade_date, q.ms_of_day, bid_size, q.bid, ask_size, q.ask,
      implied_vol FROM quotes q JOIN greeks g USING (symbol, opt_right, strike_milli, exp, trade_date, ms_of_day)""",
)
def s15(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot scans drop the greeks' own bid and ask and the quotes' exchange columns."""
    q = fx.quotes(spark, sf).withColumn("bar", F.col("ms_of_day"))
    g = fx.greeks(spark, sf).withColumn("bar", F.col("ms_of_day"))
    g = csv_scan.snapshot_greeks(g.withColumn("ms_of_day2", F.col("ms_of_day")))
    keys = ["symbol", "opt_right", "strike_milli", "exp", "trade_date", "bar"]
    joined = csv_scan.snapshot_quotes(q).join(g, keys)
    return joined.select(
        *keys[:-1], "ms_of_day", "bid_size", "bid", "ask_size", "ask", "implied_vol"
    )


@query(
    "s16_format_scan",
    """SELECT fmt, symbol, exp, count(*) AS n, sum(bid_size) AS lots
       FROM soi JOIN squotes USING (symbol, opt_right, strike_milli, exp, trade_date),
         (SELECT unnest(['csv', 'json', 'parquet']) AS fmt) GROUP BY 1, 2, 3""",
)
def s16(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.snapshot_quotes(spark, sf).join(
        fx.snapshot_open_interest(spark, sf), ["symbol", "opt_right", "strike_milli", "exp", "trade_date"]
    )
    out = []
    for fmt in tables.FORMATS:
        path = fresh_path(spark, f"fmt-{fmt}")
        wr.write_format(rows, path, fmt)
        back = tables.read_format(spark, path, fmt, rows.schema)
        out.append(back.withColumn("fmt", F.lit(fmt)))
    union = out[0].unionByName(out[1]).unionByName(out[2])
    return union.groupBy("fmt", "symbol", "exp").agg(F.count("*").alias("n"), F.sum("bid_size").alias("lots"))


@query(
    "s18_table_or_query_scan",
    "SELECT symbol, report_date, dte, 'query' AS via FROM earnings WHERE bdte <= 20 UNION ALL SELECT symbol, report_date, dte, 'table' FROM earnings",
)
def s18(spark: SparkSession, sf: str) -> DataFrame:
    fx.earnings(spark, sf).createOrReplaceTempView("upcoming_earnings")
    by_query = tables.read_table(spark, query="SELECT symbol, report_date, dte FROM upcoming_earnings WHERE bdte <= 20")
    by_name = tables.read_table(spark, table="upcoming_earnings").select("symbol", "report_date", "dte")
    return by_query.withColumn("via", F.lit("query")).unionByName(by_name.withColumn("via", F.lit("table")))


@query("s19_manifest", "SELECT DISTINCT trade_date, exp FROM chain")
def s19(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "manifest")
    wr.write_partitioned(fx.chain(spark, sf), path, ["trade_date", "exp"])
    return tables.manifest(spark, path, ["trade_date", "exp"])


@query(
    "s20_bulk_history_scan",
    """SELECT symbol AS root, CAST(exp AS VARCHAR) AS expiration, CAST(strike_milli AS VARCHAR) AS strike, opt_right AS "right",
      CAST(bid_condition AS VARCHAR) AS bid_condition, CAST(ask_exchange AS VARCHAR) AS ask_exchange,
      CAST(ms_of_day AS VARCHAR) AS ms_of_day FROM quotes WHERE trade_date = 20240105 AND exp = 20240126""",
)
def s20(spark: SparkSession, sf: str) -> DataFrame:
    """One (expiration, date) slice of the landed CSV; columns stay as they came."""
    path = fresh_path(spark, "bulk-history")
    fx.quotes(spark, sf).withColumnsRenamed(
        {"symbol": "root", "strike_milli": "strike", "opt_right": "right"}
    ).withColumns({"expiration": F.col("exp"), "date": F.col("trade_date")}).write.partitionBy(
        "exp", "trade_date"
    ).option("header", True).csv(path)
    columns = [
        "root", "right", "strike", "ms_of_day", "bid_size", "bid_condition", "bid_exchange", "bid", "ask_size",
        "ask_condition", "ask_exchange", "ask", "expiration", "date",
    ]
    landed = csv_scan.read_bulk_csv(spark, path, [*columns, "exp", "trade_date"])
    return landed.filter((F.col("exp") == "20240126") & (F.col("trade_date") == "20240105")).select(
        "root", "expiration", "strike", "right", "bid_condition", "ask_exchange", "ms_of_day"
    )


@query(
    "s21_leg_scans",
    """SELECT symbol, opt_right, strike_milli, trade_date, ms_of_day, f.exp AS exp_front, b.exp AS exp_back, f.underlying, f.implied_vol AS iv_front,
      b.implied_vol AS iv_back FROM greeks f JOIN greeks b USING (symbol, opt_right, strike_milli, trade_date, ms_of_day) WHERE f.exp < b.exp""",
)
def s21(spark: SparkSession, sf: str) -> DataFrame:
    """Both legs of every pair of listed expirations; only the front one brings the underlying."""
    keys = ["symbol", "opt_right", "strike_milli", "trade_date", "ms_of_day"]
    g = fx.greeks(spark, sf).select(*keys, "exp", "underlying", F.col("implied_vol").alias("iv"))
    pairs = ex.expiration_pairs(g)
    return join_pair_legs(*[leg_scan(g, pairs, leg, "greeks") for leg in ("front", "back")], keys)


# --------------------------------------------------------------------- sinks


@query(
    "k01_partitioned_write",
    """SELECT symbol, opt_right, strike_milli, exp, trade_date, bid,
      CASE WHEN trade_date = 20240109 THEN ask + 1 ELSE ask END AS ask FROM chain""",
)
def k01(spark: SparkSession, sf: str) -> DataFrame:
    """Writes all dates, then rewrites one: only that partition changes."""
    path = fresh_path(spark, "calendar")
    rows = fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "bid", "ask")
    wr.write_partitioned(rows, path, ["trade_date"], sort=["symbol", "strike_milli"])
    fixed = rows.filter(F.col("trade_date") == 20240109).withColumn("ask", F.col("ask") + 1)
    wr.write_partitioned(fixed, path, ["trade_date"], sort=["symbol", "strike_milli"])
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "k02_format_write",
    "SELECT symbol, opt_right, strike_milli, exp, trade_date, bid, ask, 'csv' AS fmt FROM chain UNION ALL SELECT symbol, opt_right, strike_milli, exp, trade_date, bid, ask, 'json' FROM chain",
)
def k02(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "bid", "ask")
    back = []
    for fmt in ("csv", "json"):
        path = fresh_path(spark, f"write-{fmt}")
        wr.write_format(rows, path, fmt)
        back.append(tables.read_format(spark, path, fmt, rows.schema).withColumn("fmt", F.lit(fmt)))
    return back[0].unionByName(back[1])


@query("k03_csv_append", "SELECT symbol, exp, strike_milli, opt_right, trade_date, open_interest FROM chain")
def k03(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "append-csv")
    rows = fx.chain(spark, sf).select("symbol", "exp", "strike_milli", "opt_right", "trade_date", "open_interest")
    wr.append_csv(rows.filter(F.col("opt_right") == "C"), path)
    wr.append_csv(rows.filter(F.col("opt_right") != "C"), path)
    return tables.read_format(spark, path, "csv", rows.schema)


@query(
    "k04_table_write",
    "SELECT symbol, weeks, \"Grade\" FROM grades WHERE latest UNION ALL SELECT symbol, weeks, \"Grade\" FROM grades WHERE latest AND weeks = '1'",
)
def k04(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.grades(spark, sf).filter("latest").select("symbol", "weeks", "Grade")
    path = fresh_path(spark, "table-write")
    name = "t_" + path[-32:]
    wr.write_table(rows, name, "overwrite", path)
    wr.write_table(rows.filter(F.col("weeks") == "1"), name, "append", path)
    return tables.read_table(spark, table=name)


@query(
    "k05_refresh_table",
    "SELECT symbol, strike_milli, exp, bid FROM chain",
)
def k05(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.chain(spark, sf).select("symbol", "strike_milli", "exp", "bid", "opt_right")
    path = fresh_path(spark, "table-refresh")
    name = "t_" + path[-32:]
    wr.refresh_table([rows.filter(F.col("opt_right") == r).drop("opt_right") for r in ("C", "P")], name, path)
    return tables.read_table(spark, table=name)


NOW = 1_706_400_000  # 2024-01-28 00:00 UTC


@query(
    "k06_retention_counts",
    f"""SELECT count(*) AS initial_rows, count(*) FILTER (WHERE "lastUpdated" < {NOW} - 7*86400) AS deleted_rows,
      count(*) FILTER (WHERE "lastUpdated" >= {NOW} - 7*86400) AS remaining_rows FROM versions""",
)
def k06(spark: SparkSession, sf: str) -> DataFrame:
    return wr.retention_counts(fx.versions(spark, sf), NOW)


@query(
    "k06_retained_rows",
    f"""SELECT event_id, user_id, "lastUpdated" FROM versions
      WHERE to_timestamp("lastUpdated") >= to_timestamp({NOW}) - INTERVAL 7 DAYS""",
)
def k06_rows(spark: SparkSession, sf: str) -> DataFrame:
    return wr.retained(fx.versions(spark, sf), NOW).select("event_id", "user_id", "lastUpdated")


@query(
    "k06_retention_deletes",
    f"""SELECT event_id, "lastUpdated", c.* FROM versions, (SELECT count(*) AS initial_rows, count(*) FILTER (WHERE "lastUpdated" < {NOW} - 7*86400) AS deleted_rows,
      count(*) FILTER (WHERE "lastUpdated" >= {NOW} - 7*86400) AS remaining_rows FROM versions) c WHERE "lastUpdated" >= {NOW} - 7*86400""",
)
def k06_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """The table as it is read back after its old versions are gone, beside the three counts."""
    path = fresh_path(spark, "versions")
    wr.write_partitioned(fx.versions(spark, sf), path, ["lastUpdated"])
    counts = wr.delete_old_versions(spark, path, NOW)
    left = spark.read.parquet(path).select("event_id", F.col("lastUpdated").cast("long").alias("lastUpdated"))
    return left.crossJoin(F.broadcast(counts))  # one row


@query("k07_version_stamp", f'SELECT symbol, exp, bid, CAST({NOW} AS BIGINT) AS "lastUpdated" FROM chain')
def k07(spark: SparkSession, sf: str) -> DataFrame:
    return wr.stamp_version(fx.chain(spark, sf).select("symbol", "exp", "bid"), NOW)


@query(
    "k08_failure_ledger",
    "SELECT symbol, report_date FROM earnings WHERE report_date NOT IN (20240116, 20240119)",
)
def k08(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs add their failures, the second twice as after a crash; they are gathered, and the next run skips them."""
    path = fresh_path(spark, "ledger")
    work = fx.earnings(spark, sf).withColumn("filepath", F.concat_ws("/", "symbol", F.col("report_date").cast("string")))
    for run, day in ((1, 20240116), (2, 20240119), (2, 20240119)):
        wr.append_ledger(work.filter(F.col("report_date") == day), path, run)
    wr.compact_ledger(spark, path, 2)
    return not_in(work, wr.read_ledger(spark, path), ["filepath"]).select("symbol", "report_date")


@query("k08_ledger_reset", "SELECT symbol, report_date FROM earnings")
def k08_reset(spark: SparkSession, sf: str) -> DataFrame:
    """After a reset nothing counts as failed."""
    path = fresh_path(spark, "ledger")
    work = fx.earnings(spark, sf).withColumn("filepath", F.concat_ws("/", "symbol", F.col("report_date").cast("string")))
    wr.append_ledger(work, path, 1)
    wr.reset_ledger(spark, path)
    return not_in(work, wr.read_ledger(spark, path), ["filepath"]).select("symbol", "report_date")


@query(
    "k10_alert_log",
    "SELECT symbol, weeks, alert_time, event_id % 2 AS run FROM alert_events",
)
def k10(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, the second repeated: the log holds each run once."""
    path = fresh_path(spark, "alert-log")
    alerts = fx.alert_events(spark, sf)
    for run in (0, 1, 1):
        rows = alerts.filter(F.col("event_id") % 2 == run).select("symbol", "weeks", "alert_time")
        wr.append_alerts(rows, path, run)
    return spark.read.schema("symbol string, weeks int, alert_time bigint, run bigint").parquet(path)


# ------------------------------------------------------- casting landed text


@query(
    "p16_cast_maps",
    """SELECT symbol, exp, CAST(strike_milli AS INT) AS strike_milli, opt_right, ms_of_day, bid_size,
      CAST(CAST(bid AS FLOAT) AS DOUBLE) AS bid, ask_size, CAST(CAST(ask AS FLOAT) AS DOUBLE) AS ask, trade_date FROM quotes""",
)
def p16(spark: SparkSession, sf: str) -> DataFrame:
    named = csv_scan.with_our_names(_landed_csv(spark, sf))
    cast = csv_scan.cast_slice(csv_scan.drop_null_keys(named), QUOTE_TYPES, keep=["symbol"])
    return cast.withColumns({"bid": F.col("bid").cast("double"), "ask": F.col("ask").cast("double")})


@query(
    "p17_type_inference",
    """SELECT symbol AS root, exp AS expiration, strike_milli AS strike, bid, ask,
      opt_right = 'C' AS is_call, CAST(strftime(strptime(CAST(trade_date AS VARCHAR), '%Y%m%d'), '%Y%m%d') AS INT) AS day
      FROM quotes""",
)
def p17(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns get their types from one aggregate pass over the landed table."""
    q = fx.quotes(spark, sf)
    text = q.select(
        F.col("symbol").alias("root"),
        F.col("exp").cast("string").alias("expiration"),
        F.col("strike_milli").cast("string").alias("strike"),
        F.col("bid").cast("string").alias("bid"),
        F.col("ask").cast("string").alias("ask"),
        F.when(F.col("opt_right") == "C", "True").otherwise("False").alias("is_call"),
        to_day("trade_date").cast("string").alias("day"),
    )
    typed = apply_types(text, plan_types(text, skip=("root",)))
    return typed.withColumn("day", F.date_format("day", "yyyyMMdd").cast("int"))
