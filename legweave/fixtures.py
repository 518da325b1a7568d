"""Option tables derived from the driver's star-schema tables.

Each function is a lazy plan over the given Parquet; sizes grow with it.  The
heavy ones aggregate ``lineitem`` to contract level *before* any join, so one
supplier holding a large share of the rows is reduced map-side.

Prices and sizes are built from integers with a fixed order of operations, so
two engines get the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


EXPIRATIONS = [20240119, 20240126, 20240202, 20240209]
HISTORY_DAYS = [20240102, 20240103, 20240104, 20240105, 20240108, 20240109, 20240110, 20240111]
HOLIDAYS = [20240101, 20240115, 20240219, 20240329]
# An expiration beyond every horizon, listed by a few contracts.
FAR_EXPIRATION, FAR_EVERY = 20240621, 23
OPEN_MS = 34_200_000
BAR_MS = 900_000
AS_OF = 20240212
SNAPSHOT_EPOCH = 1_704_880_800  # 2024-01-10 10:00 UTC
WEEKS = [1, 2, 3, 4, 5]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _symbol(key: str) -> Column:
    return F.concat(F.lit("S"), F.col(key).cast("string"))


def _contract_columns(li: DataFrame, n_days: int = 8, n_bars: int = 3) -> DataFrame:
    return li.select(
        "l_suppkey",
        F.when(F.col("l_linestatus") == "O", "C").otherwise("P").alias("opt_right"),
        (F.lit(98000) + F.col("l_linenumber") * 1000).cast("long").alias("strike_milli"),
        F.when(F.col("l_partkey") % FAR_EVERY == 0, FAR_EXPIRATION)
        .otherwise(_pick(EXPIRATIONS, F.col("l_partkey") % 4))
        .alias("exp"),
        F.quarter("l_shipdate").alias("q"),
        (F.col("l_orderkey") % n_days).cast("int").alias("d"),
        (F.lit(OPEN_MS) + F.floor(F.col("l_partkey") / 4) % n_bars * BAR_MS).cast("int").alias("ms_of_day"),
        "l_extendedprice",
        "l_discount",
        "l_quantity",
        "l_tax",
    )


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contract and trade date: quote, volatility, open interest."""
    contracts = (
        _contract_columns(table(spark, sf_dir, "lineitem"))
        .withColumn("trade_date", (F.lit(20240107) + F.col("q")).cast("int"))
        .groupBy("l_suppkey", "opt_right", "strike_milli", "exp", "trade_date")
        .agg(
            (F.floor(F.min("l_extendedprice")) / 1000).alias("bid"),
            (F.floor(F.min("l_extendedprice")) / 1000 + F.max("l_discount")).alias("ask"),
            F.min("l_quantity").cast("int").alias("bid_size"),
            F.max("l_quantity").cast("int").alias("ask_size"),
            (F.lit(0.2) + F.max("l_tax")).alias("implied_vol"),
            F.count("*").alias("open_interest"),
        )
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return contracts.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _symbol("l_suppkey").alias("symbol"),
        "opt_right",
        "strike_milli",
        "exp",
        "trade_date",
        "bid",
        "ask",
        "bid_size",
        "ask_size",
        (F.floor(F.lit(10000) + F.col("s_acctbal") / 50) / 100).alias("underlying"),
        "implied_vol",
        "open_interest",
    )


def history(spark: SparkSession, sf_dir: str, n_days: int = 8, n_bars: int = 3) -> DataFrame:
    """Intraday history: trade dates, bars a day, some zero underlyings."""
    bars = (
        _contract_columns(table(spark, sf_dir, "lineitem"), n_days, n_bars)
        .groupBy("l_suppkey", "opt_right", "strike_milli", "exp", "d", "ms_of_day")
        .agg(
            (F.floor(F.min("l_extendedprice")) / 1000).alias("bid"),
            (F.floor(F.min("l_extendedprice")) / 1000 + F.max("l_discount")).alias("ask"),
            F.min("l_quantity").cast("int").alias("bid_size"),
            F.max("l_quantity").cast("int").alias("ask_size"),
            F.when(F.max("l_tax") < 0.015, 0.0).otherwise(F.lit(0.2) + F.max("l_tax")).alias("implied_vol"),
            F.count("*").alias("open_interest"),
        )
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    base = F.floor(F.lit(10000) + F.col("s_acctbal") / 50) / 100
    # The first two days of every tenth supplier are listed under an old name.
    old = (F.col("l_suppkey") % 10 == 0) & (F.col("d") < 2)
    return bars.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.when(old, "O").otherwise("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        "opt_right",
        "strike_milli",
        "exp",
        _pick(HISTORY_DAYS, F.col("d")).alias("trade_date"),
        "ms_of_day",
        "bid",
        "ask",
        "bid_size",
        "ask_size",
        F.when((F.col("l_suppkey") + F.col("d")) % 17 == 0, 0.0)
        .otherwise(base + F.col("d") * 0.25)
        .alias("underlying"),
        "implied_vol",
        "open_interest",
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A denser history: six trade dates with one bar each."""
    return history(spark, sf_dir, 6, 1)


def snapshot_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_quotes_of(chain(spark, sf_dir))


def snapshot_quotes_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol", "opt_right", "strike_milli", "exp", "trade_date", "bid_size", "bid", "ask_size", "ask"
    )


def snapshot_greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_greeks_of(chain(spark, sf_dir))


def snapshot_greeks_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol",
        "opt_right",
        "strike_milli",
        "exp",
        "trade_date",
        (F.lit(OPEN_MS) + F.col("bid_size") * 10).cast("int").alias("ms_of_day"),
        (F.col("bid_size") / 64).alias("delta"),
        "implied_vol",
        "underlying",
    )


def snapshot_open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_open_interest_of(chain(spark, sf_dir))


def snapshot_open_interest_of(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(F.col("bid_size") <= 40)
        .select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "open_interest")
    )


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier snapshots: cost and sizes by symbol, weeks and date, with gaps."""
    li = table(spark, sf_dir, "lineitem")
    s, p, d = F.col("l_suppkey"), F.col("l_partkey"), (F.col("l_orderkey") % 8).cast("int")
    return li.filter((s + p % 5 + d) % 9 != 0).select(
        _symbol("l_suppkey").alias("symbol"),
        (p % 5 + 1).cast("int").alias("weeks"),
        _pick(HISTORY_DAYS, d).alias("trade_date"),
        (F.lit(20240115) + s % 9).cast("int").alias("report_date"),
        (F.floor("l_extendedprice") / 8192).alias("calCostPct"),
        F.col("l_quantity").cast("int").alias("ask_size_front"),
        (F.col("l_quantity") + 3).cast("int").alias("bid_size_front"),
        (F.lit(60) - F.col("l_quantity")).cast("int").alias("ask_size_back"),
        (F.lit(62) - F.col("l_quantity")).cast("int").alias("bid_size_back"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_of(history(spark, sf_dir))


def quotes_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol",
        "opt_right",
        "strike_milli",
        "exp",
        "trade_date",
        "ms_of_day",
        "bid_size",
        F.lit(50).alias("bid_condition"),
        F.lit(1).alias("bid_exchange"),
        "bid",
        "ask_size",
        F.lit(50).alias("ask_condition"),
        F.lit(2).alias("ask_exchange"),
        "ask",
    )


def greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greeks of the history; the smallest contracts (one open lot) have none."""
    return greeks_of(history(spark, sf_dir))


def greeks_of(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("open_interest") > 1) | (F.col("ask_size") > 5)).select(
        "symbol",
        "opt_right",
        "strike_milli",
        "exp",
        "trade_date",
        "ms_of_day",
        "bid",
        "ask",
        (F.col("bid_size") / 64).alias("delta"),
        (F.col("ask_size") / -64).alias("theta"),
        (F.col("open_interest") / 4).alias("vega"),
        "implied_vol",
        "underlying",
    )


def open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open interest per bar; none for contracts whose smallest lot is above 40."""
    return open_interest_of(history(spark, sf_dir))


def open_interest_of(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(F.col("bid_size") <= 40)
        .select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "ms_of_day", "open_interest")
    )


def earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next report of each supplier, and for some the one after, with estimates and a date comment.

    Some next reports are more than 20 business days ahead, all later ones are.
    """
    k, later = F.col("s_suppkey"), F.col("n") == 1
    reports = table(spark, sf_dir, "supplier").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    return reports.filter(~later | (k % 4 == 0)).select(
        _symbol("s_suppkey").alias("symbol"),
        (F.when(later, 20240415).otherwise(20240115) + k % 9).cast("int").alias("report_date"),
        F.col("s_nationkey").alias("noOfEsts"),
        (F.floor("s_acctbal") / 1000).alias("epsForecast"),
        F.when(later, 20240331).when(k % 2 == 0, 20231231).otherwise(20230930).alias("fiscalQuarterEnding"),
        F.when(later, 70).when(k % 6 == 5, k % 12 + 15).otherwise(k % 12 + 1).cast("int").alias("bdte"),
        F.when(later, 97).otherwise(k % 25).cast("int").alias("dte"),
        F.when(k % 5 == 0, "Same Date")
        .when(k % 5 == 1, " same week ")
        .when(k % 5 == 2, "Different Week")
        .when(k % 5 == 3, "unconfirmed")
        .alias("comment"),
        F.concat(F.lit("src"), (k % 3).cast("string")).alias("sourceUsed"),
    )


def past_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight quarterly reports back from each supplier's report date."""
    k = F.col("s_suppkey")
    first = F.expr("date'2024-01-15'")
    report = F.date_add(first, (k % 9 - F.col("n") * 91 * (k % 3 + 1)).cast("int"))
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(8)])))
        .filter((k % 10 != 9) | (F.col("n") == 0))
        .select(
            _symbol("s_suppkey").alias("symbol"),
            F.date_format(report, "yyyyMMdd").cast("int").alias("report_date"),
        )
    )


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest grades by symbol and weeks (text, with an 'Average' row), two quarters."""
    base = F.floor("s_acctbal") / 5000
    w = F.col("w")
    score = base + w * 0.125
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("w", F.explode(F.array(*[F.lit(i) for i in range(0, 7)])))
        .withColumn("latest", F.explode(F.array(F.lit(True), F.lit(False))))
        .select(
            _symbol("s_suppkey").alias("symbol"),
            F.when(w == 0, "Average").otherwise(w.cast("string")).alias("weeks"),
            "latest",
            F.when(F.col("latest"), "2023Q4").otherwise("2023Q3").alias("targetFiscalQuarter"),
            F.when(base > 1, "A").otherwise("B").alias("Grade"),
            score.alias("undmean_avg_trade_class_combined_grade"),
            (score + 0.25).alias("all_avg_trade_class_combined_grade"),
            (score - 0.25).alias("overmean_avg_trade_class_combined_grade"),
        )
    )


def backtest_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest results by symbol, weeks (text) and business days to the report."""
    k, w, b = F.col("s_suppkey"), F.col("w"), F.col("bdte")
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("w", F.explode(F.array(*[F.lit(i) for i in range(1, 7)])))
        .withColumn("bdte", F.explode(F.array(*[F.lit(i) for i in range(0, 16)])))
        .select(
            _symbol("s_suppkey").alias("symbol"),
            w.cast("string").alias("weeks"),
            "bdte",
            ((k + w) % 5 != 0).alias("latest"),
            F.when((k + w) % 5 != 0, "2023Q4").otherwise("2023Q3").alias("targetFiscalQuarter"),
            (k % 7 / 8).alias("all_str_ratio"),
            (k % 5 / 8).alias("undmean_str_ratio"),
            (k % 3 / 8).alias("overmean_str_ratio"),
            ((k * 3 + b) % 40 / 8).alias("all_pl_pct_mean"),
            ((k + b) % 30 + 1).cast("long").alias("all_total_trades"),
            ((k + w * b) % 16 / 16).alias("all_win_rate"),
            ((k * 5 + w) % 32 / 8).alias("undmean_pl_pct_mean"),
            ((k * 7 + b + w) % 32 / 8).alias("overmean_pl_pct_mean"),
        )
    )


def cost_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical calendar cost by symbol, weeks (text) and business days."""
    k, w, b = F.col("s_suppkey"), F.col("w"), F.col("bdte")
    mean = (k * 7 + b + w) % 50 / 8 + 0.5
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("w", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])))
        .withColumn("bdte", F.explode(F.array(*[F.lit(i) for i in range(0, 13)])))
        .select(
            _symbol("s_suppkey").alias("symbol"),
            "bdte",
            w.cast("string").alias("weeks"),
            mean.alias("calCostPctMean"),
            (mean / 4).alias("calCostPctStd"),
            (mean * 2).alias("calCostPctMax"),
            (mean / 8).alias("calCostPctMin"),
            (k % 12 + 4).cast("long").alias("histEarningsCount"),
            (k % 20 + 4).cast("long").alias("histCalCostCount"),
            (k % 8 != 7).alias("latest"),
        )
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that every tenth supplier has had, with dates.

    Half of them have one entry only, and a quarter none since 2016, so the rule
    for active symbols leaves them out.
    """
    k, n = F.col("s_suppkey"), F.col("n")
    return (
        table(spark, sf_dir, "supplier")
        .filter(k % 10 == 0)
        .withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
        .filter((n == 0) | (k % 20 == 0))
        .select(
            _symbol("s_suppkey").alias("symbol"),
            F.concat(F.when(n == 0, "O").otherwise("S"), k.cast("string")).alias("symbol_changes"),
            F.when(k % 40 == 0, 20140106 + n).otherwise(20180105 + n).cast("int").alias("date"),
        )
    )


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol, long name and sector; a few suppliers are not listed."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_suppkey") % 11 != 10)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(_symbol("s_suppkey").alias("symbol"), F.col("s_name").alias("longName"), F.col("n_name").alias("sector"))
    )


def muted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers that a chat has muted, with the day the mute ends."""
    k = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("chat_id", F.explode(F.array(F.lit("c1"), F.lit("c2"))))
        .filter((k % 3 == 0) & ((F.col("chat_id") == "c1") | (k % 2 == 0)))
        .select("chat_id", _symbol("s_suppkey").alias("ticker"), (F.lit(20240108) + k % 5).cast("int").alias("mute_end"))
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored calendars in three snapshot versions, the input of the alert steps."""
    li = table(spark, sf_dir, "lineitem")
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    return li.select(
        _symbol("l_suppkey").alias("symbol"),
        (p % 5 + 1).cast("int").alias("weeks"),
        F.when(F.col("l_linestatus") == "O", "C").otherwise("P").alias("opt_right"),
        (F.lit(98000) + F.col("l_linenumber") * 1000).cast("long").alias("strike_milli"),
        _pick(EXPIRATIONS, p % 4).alias("exp_front"),
        (o % 15).cast("int").alias("bdte"),
        (F.col("l_linenumber") + 5).alias("histEarningsCount"),
        ((s + o) % 9 / 8 - 0.5).alias("pct_under_over_mean"),
        F.col("l_quantity").cast("int").alias("ask_size_front"),
        (F.col("l_quantity") + 3).cast("int").alias("bid_size_front"),
        (F.lit(60) - F.col("l_quantity")).cast("int").alias("ask_size_back"),
        (F.lit(62) - F.col("l_quantity")).cast("int").alias("bid_size_back"),
        (F.col("l_discount") * 4).alias("spreadPct_front"),
        (F.col("l_tax") * 4).alias("spreadPct_back"),
        (F.col("l_discount") * 7).alias("spreadPct_cal"),
        (F.col("l_extendedprice") / 8192).alias("calCost"),
        (F.col("l_tax") * 5).alias("calGapPct"),
        ((o * 31 + p * 17 + F.col("l_linenumber")) % 1024 / 8192).alias("undPricePctDiff"),
        (F.lit(SNAPSHOT_EPOCH) + o % 3 * 1800).cast("long").alias("lastUpdated"),
        (s % 32 / 16).alias("undmean_avg_trade_class_combined_grade"),
        _pick(EXPIRATIONS, (p + s) % 4).alias("iv_max_exp_c"),
        _pick(EXPIRATIONS, (p + o) % 4).alias("iv_max_exp_p"),
        ((o * 7 + p) % 101 / 100).alias("prediction_score_1"),
        (o * 8 + F.col("l_linenumber")).alias("row_id"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert attempts: sign-up events keyed by symbol and weeks."""
    return alert_columns(events(spark, sf_dir))


def alert_columns(e: DataFrame, *more: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return e.filter(F.col("event_type") == "signup").select(
        "event_id",
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        (F.col("event_id") % 5 + 1).cast("int").alias("weeks"),
        F.unix_timestamp(ts).alias("alert_time"),
        F.date_format(ts, "yyyyMMdd").cast("int").alias("alert_date"),
        *more,
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stamped with the day of their run, as a versioned table."""
    e = events(spark, sf_dir)
    return e.select(
        "event_id",
        "user_id",
        "value",
        F.unix_timestamp("ts").alias("event_time"),
        (F.floor(F.unix_timestamp("ts") / 86400) * 86400).cast("long").alias("lastUpdated"),
    )


def with_model_columns(frame: DataFrame, absent: list[str]) -> DataFrame:
    """The frame with model inputs that no table here has, made from the strike; some volatility errors are null."""
    made = {n: (F.col("strike_milli") / 1000 + i) % 16 / 16 for i, n in enumerate(absent)}
    odd = F.col("strike_milli") % 2000 == 0
    return frame.withColumns({n: F.when(~odd, x) if n.startswith("iv_error") else x for n, x in made.items()})
