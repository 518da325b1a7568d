"""Gates, the market layout, and jobs that store what they make."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave import market
from legweave.catalog import gate_queries as gq
from legweave.operators import gates, legs
from legweave.plans import equity_history as eh
from legweave.plans import index_calendar, models, multi_gap, scored_snapshot
from legweave.plans.features import MODEL_FEATURES, missing_features
from legweave.plans.index_history import DATASETS, HistoryStore, complete_units, store_index_history, wanted_units
from legweave.schemas import BAR_KEYS
from legweave.scratch import fresh_path, settle
from legweave.sinks import writers as wr
from legweave.sources import csv_scan, scans, ticks
from legweave.streaming import runner
from legweave.streaming.bars import interval_bars
from legweave.streaming.late import DELAY_SECONDS, LateBars

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Gates


def test_watch_counts_in_the_jobs_own_pass(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b"), (9, "c"), (None, "d")], "x int, k string")
    watch = gates.Watch([gates.Gate("small", F.col("x") > 4, F.col("k")), gates.Gate("named", F.col("k").isNull(), F.col("k"))])
    seen = watch.on(df)
    assert plan_of(seen).count("Scan") == plan_of(df).count("Scan")
    settle(seen.filter("x < 3"))  # what a job keeps is its own business
    # The row whose x is unknown breaks the rule about x.
    assert watch.report() == [("small", 4, 3, "b", "d"), ("named", 4, 0, None, None)]
    assert watch.table(spark).count() == 2
    watch.require(["small"])
    with pytest.raises(gates.GateBroken, match="small: 3 of 4 rows, b to d"):
        watch.require()
    with pytest.raises(ValueError, match="one frame"):
        watch.on(df)
    with pytest.raises(ValueError, match="no frame"):
        gates.Watch([]).report()


def test_watch_on_nothing(spark):
    watch = gates.Watch(gates.nulls_in(["x"], F.col("x")))
    settle(watch.on(spark.createDataFrame([], "x int")))
    assert watch.report() == [("null_x", 0, 0, None, None)]
    watch.require()


@pytest.fixture(scope="module")
def chain(spark):
    return settle(fx.chain(spark, SF), "chain")


def test_index_job_fails_or_reports(spark, chain):
    quotes, greeks = fx.snapshot_quotes_of(chain), fx.snapshot_greeks_of(chain)
    plain = index_calendar.index_snapshot(greeks, quotes, fx.HOLIDAYS, strict=True)
    assert plain.disagreeing.count() == 0 and plain.calendars.count() > 0
    off = greeks.withColumn("underlying", F.col("underlying") + F.when(F.col("exp") == 20240202, 1.0).otherwise(0.0))
    with pytest.raises(gates.GateBroken, match="price_disagreement"):
        index_calendar.index_snapshot(off, quotes, fx.HOLIDAYS, strict=True)
    told = index_calendar.index_snapshot(off, quotes, fx.HOLIDAYS)
    days = {(r.symbol, r.trade_date) for r in told.disagreeing.collect()}
    assert days and told.watch.report()[0][2] == len(days)
    assert not days & {(r.symbol, r.trade_date) for r in told.calendars.select("symbol", "trade_date").collect()}


def test_multi_gap_job_fails_or_reports(spark):
    rows = settle(fx.daily(spark, SF), "daily")
    q, g = rows.select(*BAR_KEYS, "bid", "ask"), rows.select(*BAR_KEYS, "implied_vol", "underlying")
    assert multi_gap.multi_gap_history(q, g, strict=True).count() > 0
    odd = g.withColumn("underlying", F.col("underlying") + F.when(F.col("opt_right") == "C", 0.5).otherwise(0.0))
    with pytest.raises(gates.GateBroken, match="underlying_differs"):
        multi_gap.multi_gap_history(q, odd, strict=True)


def test_rows_agree_when_their_columns_do(spark):
    df = spark.createDataFrame([(1, 1, None, None), (1, 2, 3, 3), (1, 1, 3, None)], "a int, b int, c int, d int")
    agree = legs.duplicates_agree({"x": ["a", "b"], "y": ["c", "d"]})
    assert [r.ok for r in df.select(agree.alias("ok")).collect()] == [True, False, False]


# Layout


@pytest.fixture(scope="module")
def history(spark):
    return settle(fx.history(spark, SF), "history")


def bucketed(spark, rows, kind):
    path = fresh_path(spark, kind)
    return market.land_bucketed(rows, f"t_{path[-32:]}", path, 4)


def test_bucketed_tables_meet_without_a_shuffle(spark, history, monkeypatch):
    q, g = bucketed(spark, fx.quotes_of(history), "quotes"), bucketed(spark, fx.greeks_of(history), "greeks")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with market.buckets_kept(spark):
            made = [gq.co_located_quotes_greeks(q, g), gq.co_located_pairs(q), gq.co_located_wide(q, g)]
            assert ["Exchange" in plan_of(df) for df in made] == [False] * 3
            counts = [df.count() for df in made]
        plain = [
            gq.co_located_quotes_greeks(fx.quotes_of(history), fx.greeks_of(history)),
            gq.co_located_pairs(fx.quotes_of(history)),
            gq.co_located_wide(fx.quotes_of(history), fx.greeks_of(history)),
        ]
        assert counts == [df.count() for df in plain] and "Exchange" in plan_of(plain[0])
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    assert [market.buckets_for(n) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 9, 432]
    monkeypatch.setattr(market, "ROWS_PER_BUCKET", 300)
    landed = []
    monkeypatch.setattr(market, "land_bucketed", lambda rows, name, path, buckets: landed.append((rows.count(), buckets)) or rows)
    gq.bucketed_history(spark, SF)
    gq.j02_bucketed(spark, SF)
    (n, first), (_, second), (m, third) = landed
    assert first == second == -(-n // 300) > 8 and third == -(-m // 300)


def test_history_deals_each_table_once(spark):
    """The names of a symbol are on the contracts, so the join with them is the only one that the market's rows take part in."""
    quotes = spark.range(5).selectExpr("'O' symbol", "'C' opt_right", "id strike_milli", "1 exp", "1 trade_date", "1 ms_of_day", "id v")
    contracts = spark.createDataFrame([("A", 1, 1, 1, 2), ("B", 1, 2, 2, 2)], "symbol string, exp int, strike_milli long, from_day int, to_day int")
    roots = spark.createDataFrame([("A", "A"), ("A", "O"), ("B", "O")], "symbol string, root string")
    cut = eh.reduced(quotes, contracts.join(roots, "symbol"), 1, 2)
    assert [tuple(r) for r in cut.select("symbol", "strike_milli", "v").collect()] == [("A", 1, 1)]
    assert "root" not in cut.columns


def test_appended_days_keep_the_buckets(spark, history):
    path = fresh_path(spark, "appended")
    name = f"t_{path[-32:]}"
    rows = fx.quotes_of(history)
    market.land_bucketed(rows.filter("trade_date < 20240105"), name, path, 4)
    table = market.land_bucketed(rows.filter("trade_date >= 20240105"), name, path, 4, "append")
    assert Counter(map(tuple, table.collect())) == Counter(map(tuple, rows.collect()))


def partitions_read(df):
    """How many partitions the widest scan of a frame reads."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan whose scans can be looked at afterwards
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return max(m.apply("numPartitions").value() for m in metrics if m.contains("numPartitions"))


def test_a_plan_prunes_the_days_it_does_not_cover(spark, history):
    path = fresh_path(spark, "by-day")
    wr.write_partitioned(fx.quotes_of(history), path, ["trade_date"])
    landed = spark.read.parquet(path)
    keys = ["symbol", "exp", "strike_milli", "opt_right"]
    contracts = settle(history.select(*keys).distinct(), "contracts")

    def asked(first, last):
        return contracts.withColumns({"start_date": F.lit(first), "end_date": F.lit(last)})

    few, many = (scans.history_slices(landed, asked(20240103, last)) for last in (20240104, 20240109))
    assert "dynamicpruning" in plan_of(few)
    assert partitions_read(few) == 2 and partitions_read(many) == 5
    assert few.count() == history.filter("trade_date BETWEEN 20240103 AND 20240104").count()
    # The history jobs cut their tables the same way.
    wanted = history.select("symbol", "exp", "strike_milli", F.lit(20240103).alias("from_day"), F.lit(20240104).alias("to_day")).distinct()
    cut = eh.reduced(landed, wanted, 20240103, 20240104, market.covered_days(wanted, "from_day", "to_day"))
    assert "dynamicpruning" in plan_of(cut) and partitions_read(cut) == 2


def test_covered_days(spark):
    spans = spark.createDataFrame([(20231230, 20240102), (20240101, 20240101), (20240105, 20240103), (None, 20240101)], "a int, b int")
    assert sorted(r.trade_date for r in market.covered_days(spans, "a", "b").collect()) == [20231230, 20231231, 20240101, 20240102]


# Index history

UNIT_BARS = [("A", "C", 100, 3, 1), ("A", "P", 100, 3, 1), ("A", "C", 100, 3, 2), ("A", "P", 100, 3, 2), ("A", "C", 100, 3, 3), ("A", "P", 100, 3, 3)]


def market_of(spark, greeks_without=(), oi_days=(1, 2, 3)):
    bars = spark.createDataFrame([(*b, 5, 1.5) for b in UNIT_BARS], "symbol string, opt_right string, strike_milli long, exp int, trade_date int, ms_of_day int, x double")
    lacking = F.concat_ws("/", "opt_right", F.col("trade_date").cast("string")).isin(*greeks_without) if greeks_without else F.lit(False)
    return {"quotes": bars, "greeks": bars.filter(~lacking), "open_interest": bars.filter(F.col("trade_date").isin(*oi_days))}


def run_store(spark, store, run, tables, last_day=3, limit=3):
    limits = spark.createDataFrame([("A", limit)], "symbol string, max_days int")
    days = tables["quotes"].select("symbol", "exp", "trade_date").distinct()
    report = settle(store_index_history(spark, days, tables, limits, store, run, 0, last_day), "report")
    return Counter((r.trade_date, r.dataset, r.status) for r in report.collect())


def stored(spark, store, dataset):
    return Counter(r.trade_date for r in store.rows(spark, dataset).collect())


def test_a_second_run_stores_only_what_is_missing(spark):
    store = HistoryStore(fresh_path(spark, "store"))
    first = run_store(spark, store, 1, market_of(spark), last_day=2)
    assert first == Counter((day, d, "committed") for day in (1, 2) for d in DATASETS)
    assert run_store(spark, store, 2, market_of(spark)) == Counter((3, d, "committed") for d in DATASETS)
    assert not run_store(spark, store, 3, market_of(spark))
    assert all(stored(spark, store, d) == {1: 2, 2: 2, 3: 2} for d in DATASETS)


def test_limits_keep_the_last_days(spark):
    days = market_of(spark)["quotes"].select("symbol", "exp", "trade_date").distinct()
    limits = spark.createDataFrame([("A", 2)], "symbol string, max_days int")
    assert sorted(r.trade_date for r in wanted_units(days, limits, 0, 2).collect()) == [2]
    assert wanted_units(days.filter("trade_date < 3"), limits, 0, 9).count() == 0  # does not trade on its own day
    assert wanted_units(days, limits, 3, 9).count() == 0


def test_an_incomplete_unit_is_a_failure_and_leaves_nothing(spark):
    store = HistoryStore(fresh_path(spark, "store"))
    tables = market_of(spark, greeks_without=["P/2"], oi_days=(1, 2))
    report = run_store(spark, store, 1, tables)
    assert {k for k in report if k[0] == 2} == {(2, d, "failed") for d in DATASETS}
    assert (3, "open_interest", "absent") in report and (3, "greeks", "committed") in report
    assert all(stored(spark, store, d)[2] == 0 for d in DATASETS) and stored(spark, store, "quotes") == {1: 2, 3: 2}
    assert {r.trade_date for r in store.marks(spark, "failures").collect()} == {2}
    # The failure is skipped from now on; the open interest that has come is fetched.
    assert run_store(spark, store, 2, market_of(spark)) == Counter([(3, "open_interest", "committed")])
    assert stored(spark, store, "open_interest") == {1: 2, 3: 2}
    assert complete_units(tables["quotes"], tables["greeks"]).count() == 2


def test_a_run_that_died_before_its_commit_counts_for_nothing(spark, monkeypatch):
    from legweave.plans import index_history as ih

    store = HistoryStore(fresh_path(spark, "store"))

    def dies(rows, path, run):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(ih, "append_run", dies)
        with pytest.raises(RuntimeError):
            run_store(spark, store, 1, market_of(spark))
    assert spark.read.parquet(store.path("quotes")).count() == 6 and not stored(spark, store, "quotes")
    report = run_store(spark, store, 1, market_of(spark, oi_days=(1,)))
    assert report[1, "quotes", "committed"] == 1 and stored(spark, store, "quotes") == {1: 2, 2: 2, 3: 2}
    assert stored(spark, store, "open_interest") == {1: 2}  # nothing of the first try shows


# Ledger, versions, rejects


def test_ledger_of_a_repeated_run(spark):
    path = fresh_path(spark, "ledger")
    assert wr.read_ledger(spark, path).count() == 0
    for run, names in ((1, "ab"), (2, "bc"), (2, "bc")):
        wr.append_ledger(spark.createDataFrame([(n,) for n in names], "filepath string"), path, run)
    rows = spark.read.parquet(path)
    assert rows.count() == 4 and {r.filepath for r in wr.read_ledger(spark, path).collect()} == set("abc")
    wr.compact_ledger(spark, path, 2)
    wr.compact_ledger(spark, path, 2)
    assert Counter(r.filepath for r in spark.read.parquet(path).collect()) == Counter("abc")
    wr.reset_ledger(spark, path)
    assert wr.read_ledger(spark, path).count() == 0


def test_readers_keep_the_old_version_of_a_failed_overwrite(spark):
    root = fresh_path(spark, "versions")
    name = "v_" + root[-32:]
    wr.replace_view(spark.range(3).withColumn("v", F.lit(1)), name, root)
    with pytest.raises(Exception, match="no luck"):
        wr.replace_view(spark.range(3).withColumn("v", F.raise_error(F.lit("no luck")).cast("int")), name, root)
    assert {tuple(r) for r in spark.table(name).collect()} == {(i, 1) for i in range(3)}
    wr.replace_by_union([spark.range(1).select("id"), spark.range(2).withColumn("v", F.lit(2))], name, root)
    assert Counter(tuple(r) for r in spark.table(name).collect()) == Counter([(0, None), (0, 2), (1, 2)])
    assert wr.replace_by_union([], name, root) is None


def test_damaged_rows_and_pages_are_kept_apart(spark):
    path = fresh_path(spark, "damaged")
    lines = ["a,b", "x,1", "y,n/a", "z", "u,2,3", ",4"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    schema = spark.createDataFrame([], "a string, b int").schema
    good, bad = csv_scan.read_bulk_csv_or_reject(spark, path, schema, ["a"])
    assert [tuple(r) for r in good.collect()] == [("x", 1)]
    assert [r.a for r in good.select("a").collect()] == ["x"]  # the damage shows whatever is asked for
    assert {r.rejected for r in bad.collect()} == {"y,n/a", "z", "u,2,3", ",4"}
    path = fresh_path(spark, "damaged")
    pages = ['{"header":{"format":["date"]},"response":[[20240103]]}', '{"header":{"format":["da', '{"response":[[1]]}', "null"]
    spark.createDataFrame([(p,) for p in pages], "value string").coalesce(1).write.text(path)
    good, bad = ticks.read_pages_or_reject(spark, path)
    assert [r.trade_date for r in ticks.flatten_pages(good, {"date": "int"}, contract=False).collect()] == [20240103]
    assert bad.count() == 3


# Late ticks


def test_stream_and_corrections_equal_the_bars_of_all_ticks(spark):
    rng = random.Random(6)
    rows = [(i, "AB"[i % 2], float(i), 1_700_000_000 + rng.randrange(40_000)) for i in range(400)]
    rows.sort(key=lambda r: r[3] + (20_000 if rng.random() < 0.2 else 0))  # a fifth comes hours late
    landed, job = fresh_path(spark, "ticks"), LateBars(spark, fresh_path(spark, "late"), ["symbol"], "value", ["event_id"], 900_000)
    schema = "event_id long, symbol string, value double, at long"
    for n in range(4):
        part = spark.createDataFrame(rows[n * 100 : n * 100 + 100], schema)
        part.select("event_id", "symbol", "value", F.timestamp_seconds("at").alias("ts")).write.mode("append").parquet(landed)
        job.catch_up(runner.stream_files(spark, landed, spark.read.parquet(landed).schema))
        job.correct()
    late = spark.read.parquet(job.path("ticks")).filter("late = 1").count()
    assert late > 20
    newest = max(r[3] for r in rows)
    whole = interval_bars(spark.read.parquet(landed), ["symbol"], "value", ["event_id"], 900_000)
    want = Counter(map(tuple, whole.filter(F.col("bar_start") + 900 <= newest - DELAY_SECONDS).collect()))
    assert Counter(map(tuple, job.bars().collect())) == want
    stale = spark.read.parquet(job.path("bars")).select("symbol", "bar_start", "value", "ticks")
    assert Counter(map(tuple, stale.collect())) != want
    job.correct()
    assert Counter(map(tuple, job.bars().collect())) == want


# Models and the scored snapshot


def test_a_model_file_is_loaded_once(spark):
    calls = []

    class Shared:
        value = b"{}"

    def loads(content):
        calls.append(content)
        return lambda pdf: pdf["x"]

    assert models.loaded("digest", Shared, loads) is models.loaded("digest", Shared, loads) and calls == [b"{}"]
    models._LOADED.pop("digest")
    path = fresh_path(spark, "model")
    models.save_model_file(spark, json.dumps({"x": 2.0}).encode(), path)
    models.save_model_file(spark, json.dumps({"x": 1.0}).encode(), path)
    scored = models.score_with_file(spark.range(6).selectExpr("id", "double(id) AS x"), path, gq.loads_logistic, ["x"], ["id"])
    assert {r.id: r.prediction_label for r in scored.collect()} == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1, 5: 1}


def test_model_files_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(models, "MOST_MODEL_BYTES", 3)
    with pytest.raises(ValueError, match="at most 3 bytes"):
        models.save_model_file(spark, b"1234", "unused")


def test_a_snapshot_without_an_input_is_not_scored(spark):
    rows = spark.createDataFrame([("A", 1.0, "C", 1, 1, 2)], "symbol string, strike double, opt_right string, exp_front int, weeks int, trade_date int")
    assert len(missing_features(rows)) == len(MODEL_FEATURES) - 3
    with pytest.raises(ValueError, match="columns missing"):
        scored_snapshot.scored_snapshot(rows, rows, lambda f: f, 1)
    score = {f"prediction_score_{i}": F.lit(0.5) for i in (0, 1)} | {"prediction_label": F.lit(0)}
    two = rows.unionByName(rows.withColumn("trade_date", F.lit(3)))
    out = scored_snapshot.scored_snapshot(two, rows, lambda f: f.withColumns(score), 7, wanted=["symbol"])
    assert {(r.trade_date, r.prediction_score_1, r.lastUpdated) for r in out.collect()} == {(2, 0.5, 7), (3, None, 7)}


# Work that is left


def test_a_repeated_alert_run_logs_the_same(spark):
    from legweave.plans import alert_run

    scored = settle(fx.candidates(spark, "/root/testdata/sf0.01"), "scored")
    path = fresh_path(spark, "alerts")
    first = scored.filter(F.col("lastUpdated") == fx.SNAPSHOT_EPOCH)
    late = scored.withColumn("lastUpdated", fx.SNAPSHOT_EPOCH + 3601 + F.lit(0).cast("long"))
    n = alert_run.run_alerts(spark, first, path, 1).count()
    assert n > 0 and alert_run.run_alerts(spark, first, path, 1).count() == n
    log = alert_run.read_alert_log(spark, path)
    assert log.count() == n == log.select("symbol", "weeks").distinct().count()
    # An hour and a second later every key may alert again.
    keys = {(r.symbol, r.weeks) for r in alert_run.run_alerts(spark, late, path, 2).collect()}
    assert {(r.symbol, r.weeks) for r in log.collect()} <= keys
    assert alert_run.run_alerts(spark, late.filter("weeks = 9"), path, 3).count() == 0


def test_multi_gap_runs_skip_what_is_done(spark):
    rows = settle(fx.daily(spark, SF), "daily")
    q, g = rows.select(*BAR_KEYS, "bid", "ask"), rows.select(*BAR_KEYS, "implied_vol", "underlying")
    nothing = spark.createDataFrame([], "filepath string")
    whole = multi_gap.multi_gap_run(q, g, nothing, 20240101, 20240212)
    units = {r.filepath for r in whole.rows.select("filepath").distinct().collect()}
    failed = {r.filepath for r in whole.failures.collect()}
    assert units and not units & failed and all("20240621" not in u for u in units | failed)
    one = sorted(units)[0]
    done = spark.createDataFrame([(u,) for u in failed | {one}], "filepath string")
    again = multi_gap.multi_gap_run(q, g, done, 20240101, 20240212)
    assert {r.filepath for r in again.rows.select("filepath").distinct().collect()} == units - {one}
    assert again.failures.count() == 0
    assert multi_gap.multi_gap_run(q, g, nothing, 20240105, 20240212).rows.count() == 0


def test_a_cluster_must_name_its_shared_folder():
    from legweave.scratch import shared_root

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
