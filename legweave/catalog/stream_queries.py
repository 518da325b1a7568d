"""Queries for streaming operators (X*), each over all landed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.ctes import define
from legweave.catalog.registry import query
from legweave.operators import alerts
from legweave.scratch import fresh_path
from legweave.sinks.writers import retained
from legweave.streaming import cooldown, day_cooldown, runner
from legweave.streaming.bars import WATERMARK, interval_bars
from legweave.streaming.latest import latest_per_key, upsert_log
from legweave.streaming.snapshots import priced_snapshots

EVENT_FILES = "events.parquet"


def event_stream(spark, sf):
    """The driver's event table as a file stream with a proper event time."""
    schema = fx.table(spark, sf, "events").schema
    raw = runner.stream_files(spark, sf, schema, EVENT_FILES)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


VERSION = 1_706_400_000


@query(
    "x01_versioned_snapshots",
    f'SELECT symbol, opt_right, strike_milli, exp, trade_date, (ask - bid) / 2 + bid AS mark, CAST({VERSION} AS BIGINT) AS "lastUpdated" FROM squotes',
)
def x01(spark, sf):
    """Landed quote files, priced, stamped and appended by a checkpointed stream."""
    landed = fresh_path(spark, "landed-quotes")
    rows = fx.snapshot_quotes(spark, sf)
    rows.write.parquet(landed)
    stream = priced_snapshots(runner.stream_files(spark, landed, rows.schema, files_per_batch=4), VERSION)
    out = runner.run_to_table(stream, "snapshots")
    return out.select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "mark", "lastUpdated")


@query(
    "x02_alert_cooldown_run",
    """SELECT a.event_id, a.symbol, a.weeks, a.alert_time FROM (SELECT * FROM alert_events WHERE event_id % 3 <> 1) a LEFT JOIN
      (SELECT symbol, weeks, alert_date, max(alert_time) AS last FROM alert_events WHERE event_id % 3 = 1 GROUP BY 1, 2, 3) l
      ON a.symbol = l.symbol AND a.weeks = l.weeks AND a.alert_date = l.alert_date WHERE last IS NULL OR alert_time - last > 3600""",
)
def x02_run(spark, sf):
    """Runs of two thirds of the attempts against a log of the rest."""
    every = fx.alert_events(spark, sf)
    emitted = alerts.past_cooldown(every.filter(F.col("event_id") % 3 != 1), every.filter(F.col("event_id") % 3 == 1))
    return emitted.select("event_id", "symbol", "weeks", "alert_time")


define(
    "attempts",
    "SELECT symbol, weeks, alert_date, alert_time, min(event_id) AS event_id FROM alert_events GROUP BY 1, 2, 3, 4",
)
REPLAY_SQL = """WITH RECURSIVE emitted AS (
  SELECT symbol, weeks, alert_date, min(alert_time) AS alert_time FROM attempts GROUP BY 1, 2, 3
  UNION ALL
  SELECT a.symbol, a.weeks, a.alert_date, min(a.alert_time) FROM emitted e JOIN attempts a
    ON a.symbol = e.symbol AND a.weeks = e.weeks AND a.alert_date = e.alert_date AND a.alert_time - e.alert_time > 3600
  GROUP BY a.symbol, a.weeks, a.alert_date)
SELECT e.symbol, e.weeks, e.alert_date, e.alert_time, a.event_id FROM emitted e JOIN attempts a USING (symbol, weeks, alert_date, alert_time)"""


@query("x02_alert_cooldown_replay", REPLAY_SQL)
def x02_replay(spark, sf):
    return cooldown.replay_cooldown(fx.alert_events(spark, sf))


@query("x02_alert_cooldown_stream", REPLAY_SQL)
def x02_stream(spark, sf):
    with runner.ttl_state(spark):
        return runner.run_to_table(cooldown.cooldown_stream(fx.alert_columns(event_stream(spark, sf))), "cooldown")


BAR_SQL = """SELECT symbol, bar_start, value, ticks FROM (SELECT symbol, bar_start, arg_max(value, event_id) AS value, count(*) AS ticks FROM (
  SELECT concat('S', user_id % 10) AS symbol, CAST(floor(floor(epoch(ts)) / {s}) * {s} AS BIGINT) AS bar_start, value, event_id FROM events)
  GROUP BY 1, 2)"""
IVL_MS = 900_000
SHORT_IVL_MS = 300_000


def _ticks(events):
    return events.select("ts", F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"), "value", "event_id")


@query("x03_interval_bars", BAR_SQL.format(s=IVL_MS // 1000))
def x03(spark, sf):
    return interval_bars(_ticks(fx.events(spark, sf)), ["symbol"], "value", ["event_id"], IVL_MS)


@query("x03_interval_bars_short", BAR_SQL.format(s=SHORT_IVL_MS // 1000))
def x03_short(spark, sf):
    return interval_bars(_ticks(fx.events(spark, sf)), ["symbol"], "value", ["event_id"], SHORT_IVL_MS)


@query(
    "x03_interval_bars_stream",
    BAR_SQL.format(s=IVL_MS // 1000)
    + " WHERE bar_start + 900 <= (SELECT floor(max(epoch(ts))) FROM events) - 1800",
)
def x03_stream(spark, sf):
    """Bars that the watermark has closed; the newest stay open in the state."""
    bars = interval_bars(_ticks(event_stream(spark, sf)), ["symbol"], "value", ["event_id"], IVL_MS, WATERMARK)
    return runner.run_to_table(bars, "bars")


LATEST_SQL = """SELECT user_id, event_id, value, "lastUpdated" FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY "lastUpdated" DESC, event_id DESC) AS place FROM versions) WHERE place = 1"""


@query("x04_latest_state", LATEST_SQL)
def x04(spark, sf):
    return latest_per_key(fx.versions(spark, sf), ["user_id"], ["value"], ["lastUpdated", "event_id"])


@query("x04_latest_state_stream", LATEST_SQL)
def x04_stream(spark, sf):
    """Updates of each micro-batch are logged by batch; the newest per key is read."""
    log = fresh_path(spark, "latest-log")
    e = event_stream(spark, sf)
    versions = e.select(
        "event_id", "user_id", "value", (F.floor(F.unix_timestamp("ts") / 86400) * 86400).cast("long").alias("lastUpdated")
    )
    newest = latest_per_key(versions, ["user_id"], ["value"], ["lastUpdated", "event_id"])
    runner.catch_up_batches(newest, upsert_log(log), fresh_path(spark, "latest-state"))
    logged = spark.read.schema("user_id bigint, lastUpdated bigint, event_id bigint, value double").parquet(log)
    return latest_per_key(logged, ["user_id"], ["value"], ["lastUpdated", "event_id"])


@query(
    "x05_state_retention",
    REPLAY_SQL + f" WHERE e.alert_time >= {VERSION} - 7 * 86400",
)
def x05(spark, sf):
    """The cooldown stream with a state TTL, and row retention on its sink."""
    with runner.ttl_state(spark):
        stream = cooldown.cooldown_stream(fx.alert_columns(event_stream(spark, sf)), ttl_ms=cooldown.STATE_TTL_MS)
        log = runner.run_to_table(stream, "retained")
    kept = retained(log.withColumn("lastUpdated", F.col("alert_time")), VERSION, 7)
    return kept.drop("lastUpdated")


# The watermark at the end of all attempts, and the second before which every alert has been given out.
SETTLED_SQL = f"(SELECT max(epoch_ms(ts)) - {day_cooldown.DELAY_SECONDS} * 1000 FROM events WHERE event_type = 'signup')"


def _timed_attempts(spark, sf):
    """The attempts as a stream with their event time."""
    return fx.alert_columns(event_stream(spark, sf), "ts")


@query("x05_day_timers", REPLAY_SQL + f" WHERE (e.alert_time + 1) * 1000 <= {SETTLED_SQL}")
def x05_timers(spark, sf):
    """The cooldown under event time: timers settle each second behind the watermark, and end each key's day."""
    with runner.timed_state(spark):
        return runner.run_to_table(day_cooldown.day_cooldown_stream(_timed_attempts(spark, sf)), "timed")


RETAIN_DAYS = 3


@query(
    "x05_retaining_sink",
    f"""SELECT * FROM ({REPLAY_SQL} WHERE (e.alert_time + 1) * 1000 <= {SETTLED_SQL})
      QUALIFY date_diff('day', strptime(alert_date::VARCHAR, '%Y%m%d'), max(strptime(alert_date::VARCHAR, '%Y%m%d')) OVER ()) <= {RETAIN_DAYS}""",
)
def x05_sink(spark, sf):
    """The same stream into a sink that drops its old days while it runs."""
    out = fresh_path(spark, "retaining")
    with runner.timed_state(spark):
        alerts = day_cooldown.day_cooldown_stream(_timed_attempts(spark, sf))
        runner.catch_up_batches(alerts, day_cooldown.retaining_sink(spark, out, RETAIN_DAYS), fresh_path(spark, "retaining-state"), "append")
    return spark.read.schema(alerts.schema).parquet(out).select(*alerts.columns)


@query("x06_incremental_backfill", "SELECT symbol, opt_right, strike_milli, exp, trade_date, bid FROM chain")
def x06(spark, sf):
    """Two landings, two catch-up runs: the second reads only the new files."""
    landed, out, state = (fresh_path(spark, n) for n in ("landing", "backfill", "backfill-state"))
    rows = fx.chain(spark, sf).select("symbol", "opt_right", "strike_milli", "exp", "trade_date", "bid")
    for late in (False, True):
        rows.filter((F.col("trade_date") > 20240109) == late).write.mode("append").parquet(landed)
        runner.catch_up(runner.stream_files(spark, landed, rows.schema), out, state)
    return spark.read.schema(rows.schema).parquet(out)
