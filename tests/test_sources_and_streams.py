"""Landed files, sinks and streams on small tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from legweave.operators.alerts import COOLDOWN_SECONDS
from legweave.scratch import fresh_path
from legweave.sinks import writers as wr
from legweave.sources import csv_scan, tables, ticks
from legweave.streaming import cooldown, day_cooldown, runner

PAGES = [
    '{"header":{"format":["ms_of_day","bid","date"]},"response":[{"contract":{"root":"A","expiration":20240119,"strike":100000,"right":"C"},"ticks":[[1,2.5,20240102],[9,9,9]]}]}',
    '{"header":{"format":["date","bid"]},"response":[[20240103,3.5],[20240104,4.5,77]]}',
]


def test_tick_pages(spark, rows):
    path = fresh_path(spark, "pages")
    spark.createDataFrame([(p,) for p in PAGES], "value string").coalesce(1).write.text(path)
    flat = ticks.flatten_pages(ticks.read_pages(spark, path), {"bid": "double", "date": "int", "ms_of_day": "int"})
    assert rows(flat, "symbol", "strike_milli", "bid", "trade_date", "ms_of_day") == [
        ("A", 100000, 2.5, 20240102, 1), (None, None, 3.5, 20240103, None), (None, None, 4.5, 20240104, None),
    ]


def test_csv_header_is_checked(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).csv(path)
    assert csv_scan.read_bulk_csv(spark, path, ["a", "b"]).count() == 1
    with pytest.raises(Exception):
        csv_scan.read_bulk_csv(spark, path, ["a", "x"]).collect()


def test_formats_and_table_arguments(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        wr.write_format(df, "unused", "xml")
    with pytest.raises(ValueError):
        tables.read_table(spark)
    with pytest.raises(Exception):
        tables.read_table(spark, table="no_such_table").collect()


def test_retention_bounds(spark):
    now, day = 1_000_000, wr.SECONDS_PER_DAY
    df = spark.createDataFrame([(now - 7 * day,), (now - 7 * day - 1,)], "lastUpdated bigint")
    assert tuple(wr.retention_counts(df, now).first()) == (2, 1, 1)
    assert [r[0] for r in wr.retained(df, now).collect()] == [now - 7 * day]


def test_existing_path(spark):
    path = fresh_path(spark, "there")
    assert not tables.exists(spark, path)
    spark.range(1).write.parquet(path)
    assert tables.exists(spark, path)


def emitted_by_loop(attempts):
    last, out = {}, set()
    for symbol, weeks, day, t, event in sorted(attempts, key=lambda a: (a[3], a[4])):
        key = (symbol, weeks, day)
        if key not in last or t - last[key] > COOLDOWN_SECONDS:
            last[key] = t
            out.add(event)
    return out


def attempts():
    times = [0, 3600, 3601, 3601, 5000, 7201, 7202, 7203, 12000]
    return [("A", 1, 1, t, i) for i, t in enumerate(times)] + [("B", 2, d, 10 * d, 100 + d) for d in range(5)]


SCHEMA = "symbol string, weeks int, alert_date int, alert_time bigint, event_id bigint"


def test_replayed_cooldown_equals_loop(spark):
    df = spark.createDataFrame(attempts(), SCHEMA)
    assert {r.event_id for r in cooldown.replay_cooldown(df).collect()} == emitted_by_loop(attempts())


def test_streamed_cooldown_survives_a_restart(spark):
    """Two landings in time order, a restart from the checkpoint between them."""
    landed, out, state = (fresh_path(spark, n) for n in ("attempts", "emitted", "state"))
    df = spark.createDataFrame(attempts(), SCHEMA)
    for late in (False, True):
        df.filter((F.col("alert_time") > 4000) == late).write.mode("append").parquet(landed)
        with runner.ttl_state(spark):
            stream = cooldown.cooldown_stream(runner.stream_files(spark, landed, df.schema))
            runner.catch_up(stream, out, state)
    got = [r.event_id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == emitted_by_loop(attempts())


def timed_attempts(days, seed):
    """Attempts of several days, many in one second, in an order of arrival that is off by up to 20 minutes."""
    rng = random.Random(seed)
    out = []
    for event in range(60 * days):
        at = 1_700_006_400 + rng.randrange(days * 86_400) // 700 * 700 + rng.choice((0, 0, 1))
        day = int(datetime.datetime.fromtimestamp(at, datetime.timezone.utc).strftime("%Y%m%d"))
        out.append((f"{'AB'[event % 2]}", 1 + event % 2, day, at, event))
    return sorted(out, key=lambda a: a[3] + rng.randrange(1_200))


def land(spark, path, rows):
    timed = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("alert_time"))
    timed.coalesce(1).write.mode("append").parquet(path)
    return timed.schema


def test_day_timers_settle_attempts_out_of_order_over_restarts(spark):
    """Four days in eight landings, the stream restarted after each: what the watermark has passed equals the loop."""
    rows = timed_attempts(4, 5)
    landed, out, state = (fresh_path(spark, n) for n in ("timed", "timed-out", "timed-state"))
    held = []
    for n in range(8):
        schema = land(spark, landed, rows[n * 30 : n * 30 + 30])
        with runner.timed_state(spark):
            alerts = day_cooldown.day_cooldown_stream(runner.stream_files(spark, landed, schema))
            run = runner.catch_up_batches(alerts, day_cooldown.retaining_sink(spark, out, 100), state, "append")
        held.append(run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    passed = max(r[3] for r in rows) - day_cooldown.DELAY_SECONDS
    at = {r[4]: r[3] for r in rows}
    got = [r.event_id for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == {e for e in emitted_by_loop(rows) if at[e] + 1 <= passed}
    # Keys of closed days are gone, so the state does not grow with the days.
    assert max(held[4:]) <= max(held[:4]) + 4


def test_attempts_behind_the_watermark_change_nothing(spark):
    base = 1_700_006_400
    landed, out, state = (fresh_path(spark, n) for n in ("behind", "behind-out", "behind-state"))
    parts = [
        [("A", 1, 20231115, base + 5_000, 1), ("A", 1, 20231115, base + 20_000, 2)],
        [("A", 1, 20231115, base + 100, 0), ("A", 1, 20231115, base + 19_000, 3), (None, 1, 20231115, base + 50_000, 4)],
        [("A", 1, None, base + 60_000, 5), ("A", 1, 20231116, base + 90_000, 6), ("A", 1, 20231116, base + 90_000, 7)],
        [("Z", 1, 20231120, base + 500_000, 8)],
    ]
    for rows in parts:
        schema = land(spark, landed, rows)
        with runner.timed_state(spark):
            stream = day_cooldown.day_cooldown_stream(runner.stream_files(spark, landed, schema))
            runner.catch_up(stream, out, state)
    # Event 0 came too late; 3 came in time and rules out 2, which is within the hour after it.
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 3, 4, 6]


def test_sink_drops_old_days_and_survives_a_repeated_batch(spark):
    path = fresh_path(spark, "sink")
    write = day_cooldown.retaining_sink(spark, path, 2)
    schema = "symbol string, weeks int, alert_date int, alert_time bigint, event_id bigint"
    write(spark.createDataFrame([], schema), 0)
    assert day_cooldown.expired_days(spark, path, 2) == []
    days = [20240227, 20240228, 20240229, 20240301, 20240302]
    for n, day in enumerate(days, 1):
        batch = spark.createDataFrame([("A", 1, day, 10 * n, n), ("A", 1, days[max(n - 2, 0)], 10 * n + 1, 100 + n)], schema)
        write(batch, n)
        write(batch, n)
        kept = {r.alert_date for r in spark.read.parquet(path).select("alert_date").collect()}
        assert kept == set(days[max(n - 3, 0) : n])
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == [3, 4, 5, 104, 105]


def test_partitioned_write_rebalances_and_replaces(spark, rows):
    path = fresh_path(spark, "parts")
    df = spark.createDataFrame([(d, i) for d in (1, 2) for i in range(5)], "day int, i int")
    wr.write_partitioned(df, path, ["day"], ["i"])
    wr.write_partitioned(spark.createDataFrame([(2, 99)], "day int, i int"), path, ["day"])
    assert rows(spark.read.parquet(path), "day", "i") == [*[(1, i) for i in range(5)], (2, 99)]
    plan = df.hint("rebalance", F.col("day"))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
