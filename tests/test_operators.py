"""Golden rows for the edges of each operator."""

import math
import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from legweave import session
from legweave.functions import labels as lb
from legweave.functions.numeric import finite_or_null, least_strict, round_half_even
from legweave.functions.pricing import calendar_metrics, iv_front_back_diff
from legweave.operators import alerts, expirations as ex, filters, ivchain, legs, planning
from legweave.operators.trading_calendar import calendar_index, with_day_counts
from legweave.operators.trend import TREND_MEASURES, trend_slice
from legweave.operators.typeplan import infer_types, plan_types
from legweave.plans.features import MODEL_FEATURES, matthews, missing_features
from legweave.skew import attach_aggregates, hot_keys, salted_join, top_k

HOLIDAYS = [20240101, 20240115]


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize("value,digits,want", [(1.005, 2, 1.0), (12.345, 2, 12.34), (2.5, 0, 2.0), (3.5, 0, 4.0), (-0.125, 2, -0.12)])
def test_round_half_even(spark, value, digits, want):
    assert one(spark, round_half_even(F.lit(value), digits)) == want


def test_nonfinite_and_missing_values(spark):
    assert one(spark, finite_or_null(F.lit(float("inf")))) is None
    assert one(spark, finite_or_null(F.lit(float("nan")))) is None
    assert one(spark, finite_or_null(F.lit(1.5))) == 1.5
    assert one(spark, least_strict(F.lit(3), F.lit(None).cast("int"))) is None


@pytest.mark.parametrize("front,back,want", [(0.0, 0.0, 0.0), (0.0, 0.3, 1.0), (0.0, None, 1.0), (0.5, 0.25, 0.5), (None, 0.25, None)])
def test_iv_difference_zero_rules(spark, front, back, want):
    got = one(spark, iv_front_back_diff(F.lit(front).cast("double"), F.lit(back).cast("double")))
    assert got == want


def test_zero_ask_gives_null_spread_share(spark):
    m = calendar_metrics(F.lit(1.0), F.lit(1.2), F.lit(0.9), F.lit(1.0), F.lit(100.0))
    assert one(spark, m["ask_cal"]) == 0.0
    assert one(spark, m["spreadPct_cal"]) is None


def test_unknown_weeks_is_an_error(spark):
    with pytest.raises(Exception, match="no gap limit"):
        one(spark, lb.gap_limit(F.lit(7)))


def test_score_tier_and_label_bounds(spark):
    assert one(spark, lb.prediction_label(F.lit(0.85))) == 0
    assert [one(spark, lb.score_tier(F.lit(s))) for s in (0.96, 0.95, 0.9, 0.51, 0.0)] == ["top", "high", "good", "fair", "none"]


@pytest.mark.parametrize(
    ("moneyness", "kept"),
    [
        ([0.01], [0]),  # one row in the band is kept whatever its rung
        ([0.01, 0.051, -0.0031], [0]),  # the band's bounds are inclusive, beyond them nothing counts
        ([0.05, -0.003], [0, 1]),
        ([0.04, 0.001, 0.002], [1, 2]),  # the second rung has two, so the wide one goes
        ([0.04, 0.001, 0.03], [1, 2]),  # 0.03 stands in an earlier rung than 0.04
        ([0.0, 0.0, 0.0], [0, 1]),  # all in the first rung: the lowest strikes
        ([0.003, 0.0031, 0.0], [0, 2]),  # a rung's bound belongs to it
        ([-0.00025, -0.00026, 0.0], [0, 2]),
        ([0.049, 0.05, 0.001], [0, 1]),  # the last rung ends at 0.048 and has one, so the band decides
    ],
)
def test_ladder_by_hand(spark, moneyness, kept):
    data = [(1, 90 + i, x) for i, x in enumerate(moneyness)]
    df = spark.createDataFrame(data, "g int, strike_milli int, undPricePctDiff double")
    got = sorted(r.strike_milli - 90 for r in filters.near_the_money(df, ["g"], 2).collect())
    assert got == kept


def test_ladder_takes_the_smallest_rung_that_has_enough(spark):
    """Stated by counts per rung: of all rungs whose count reaches the number wanted, the narrowest decides."""
    rnd = random.Random(5)
    data = [
        (g, 90 + i, rnd.choice([0.0, -0.003, 0.05, 0.003, rnd.uniform(-0.006, 0.056), rnd.uniform(0, 0.02)]))
        for g in range(60)
        for i in range(rnd.randint(1, 9))
    ]
    want = set()
    for g in range(60):
        rows = [(k, x) for h, k, x in data if h == g and filters.BAND_LOW <= x <= filters.BAND_HIGH]
        inside = [[k for k, x in rows if low <= x <= high] for low, high in filters.ladder_rungs()]
        enough = min((strikes for strikes in inside if len(strikes) >= 2), key=len, default=[k for k, _ in rows])
        want |= {(g, k) for k in sorted(enough)[:2]}
    df = spark.createDataFrame(data, "g int, strike_milli int, undPricePctDiff double")
    assert {(r.g, r.strike_milli) for r in filters.near_the_money(df, ["g"], 2).collect()} == want


def test_ladder_trims_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("strike_milli"), F.lit(0.01).alias("undPricePctDiff"))
    plan = filters.near_the_money(df, ["g"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("off", [0, 1, -1, 2, -2, 3, -3])
def test_back_expiration_offsets(spark, rows, off):
    base = 20240119
    ideal = {0: 20240126, 1: 20240127, -1: 20240125, 2: 20240128, -2: 20240124, 3: 20240129, -3: 20240123}
    worse = [ideal[o] for o in ex.BACK_DAY_OFFSETS[ex.BACK_DAY_OFFSETS.index(off):]]
    df = spark.createDataFrame([("A", 20240118, 1)], "symbol string, report_date int, weeks int")
    lists = spark.createDataFrame([("A", sorted([base, *worse]))], "symbol string, expirations array<int>")
    assert rows(ex.choose_expirations(df, lists), "exp_front", "exp_back") == [(base, ideal[off])]


def test_expiration_choice_drops(spark, rows):
    plan = spark.createDataFrame([("A", 20240112, 1), ("B", 20240113, 1), ("C", 20240119, 1)], "symbol string, report_date int, weeks int")
    lists = spark.createDataFrame(
        [("A", [20240119, 20240126]), ("B", [20240119, 20240126]), ("C", [20240119, 20240130])], "symbol string, expirations array<int>"
    )
    # A: front exactly seven days after the report.  C: nothing within three days of the target.
    assert rows(ex.choose_expirations(plan, lists), "symbol") == [("B",)]


def test_day_counts_half_open_and_negative(spark, rows):
    df = spark.createDataFrame([(20240112, 20240116), (20240116, 20240112), (20240102, 20240102)], "a int, b int")
    got = rows(with_day_counts(df, HOLIDAYS, "a", "b", "earnings"), "a", "b", "bdte", "dte")
    assert got == [(20240102, 20240102, 0, 0), (20240112, 20240116, 1, 4), (20240116, 20240112, -1, -4)]


def test_open_days_of_any_span_equal_a_count(spark):
    """The closed form against counting day by day, on both sides of its origin."""
    holidays = [19690101, 19700101, 20240101, 20240115, 20240113, 20241225]
    first = date(1968, 12, 20)
    days = [first + timedelta(days=i) for i in (0, 1, 5, 9, 12, 13, 20, 370, 376, 381, 382, 383, 500, 20_000, 20_115, 20_129, 20_500)]
    number = lambda d: d.year * 10_000 + d.month * 100 + d.day
    df = spark.createDataFrame([(number(a), number(b)) for a in days for b in days], "a int, b int")
    for r in with_day_counts(df, holidays, "a", "b", "earnings").collect():
        a, b = (date(x // 10_000, x // 100 % 100, x % 100) for x in sorted((r.a, r.b)))
        every = [a + timedelta(days=i) for i in range((b - a).days)]
        count = sum(d.weekday() < 5 and number(d) not in holidays for d in every)
        assert r.bdte == (count if r.a <= r.b else -count)


def test_calendar_table_counts_from_its_first_day(spark, rows):
    got = rows(calendar_index(spark, 20240112, 20240117, [20240115]))
    assert got == [(20240112, True, 0), (20240113, False, 1), (20240114, False, 1), (20240115, False, 1), (20240116, True, 1), (20240117, True, 2)]


def test_trend_slice_gaps(spark):
    def trend(symbol, bdtes, count=5):
        return [(symbol, 1, b, *[float(b)] * len(TREND_MEASURES[:4]), count, *[float(b)] * 6) for b in bdtes]

    data = trend("A", [5, 6, 7]) + trend("B", [6, 7, 8]) + trend("C", [5, 6, 8]) + trend("D", [5, 6, 7], 4) + trend("E", [5, 6, 7, 8])
    schema = "symbol string, weeks int, bdte int, " + ", ".join(
        f"`{m}` {'bigint' if m == 'count' else 'double'}" for m in TREND_MEASURES
    )
    trades = spark.createDataFrame([(s, 1, 5) for s in "ABCDE"], "symbol string, weeks int, bdte int")
    got = {r.symbol: (r.pre_0_avg, r.pre_2_avg) for r in trend_slice(trades, spark.createDataFrame(data, schema)).collect()}
    assert got == {"A": (5.0, 7.0), "B": (6.0, 8.0), "E": (5.0, 7.0)}


def test_cooldown_is_strict(spark, rows):
    columns = "symbol string, weeks int, alert_date int, alert_time bigint"
    run = spark.createDataFrame([("A", 1, 1, 7200), ("B", 1, 1, 7201), ("C", 1, 1, 100), ("A", 1, 2, 7200)], columns)
    log = spark.createDataFrame([("A", 1, 1, 3600), ("B", 1, 1, 3600), ("B", 1, 1, 10)], columns)
    assert rows(alerts.past_cooldown(run, log), "symbol", "alert_date") == [("A", 2), ("B", 1), ("C", 1)]


def test_short_state_lets_a_key_alert_again(spark, tmp_path):
    """The state of a key is gone after its time to live, so a second run emits within the cooldown."""
    from legweave.streaming import cooldown, runner

    columns = "symbol string, weeks int, alert_date int, alert_time bigint, event_id bigint"
    landed = str(tmp_path / "landed")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    emitted = []
    with runner.ttl_state(spark):
        for n, at in enumerate((100, 200)):
            spark.createDataFrame([("A", 1, 1, at, n)], columns).write.mode("append").parquet(landed)
            stream = cooldown.cooldown_stream(spark.readStream.schema(columns).parquet(landed), ttl_ms=500)
            query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
            query.awaitTermination()
            emitted.append(spark.read.parquet(out).count())
            time.sleep(1)
    assert emitted == [1, 2]


def test_mute_ending_today_is_over(spark, rows):
    a = spark.createDataFrame([("c1", "A"), ("c1", "B"), ("c2", "B")], "chat_id string, symbol string")
    m = spark.createDataFrame([("c1", "A", 20240110), ("c1", "B", 20240111)], "chat_id string, ticker string, mute_end int")
    assert rows(alerts.not_muted(a, m, 20240110), "chat_id", "symbol") == [("c1", "A"), ("c2", "B")]


def test_nearest_strike_prefers_lower_on_tie(spark, rows):
    columns = "symbol string, trade_date int, opt_right string, strike_milli bigint, n_exp bigint"
    strikes = spark.createDataFrame([("A", 1, "C", 99000, 2), ("A", 1, "C", 101000, 2)], columns)
    und = spark.createDataFrame([("A", 1, 100.0)], "symbol string, trade_date int, underlying double")
    assert rows(ivchain.nearest_strike(strikes, und), "strike_milli") == [(99000,)]


def test_peak_ignores_missing_volatility(spark, rows):
    data = [("A", 9, "C", 1, 0.5), ("A", 9, "C", 2, float("nan")), ("A", 9, "C", 3, None), ("A", 9, "C", 4, 0.5), ("A", 8, "C", 2, 0.1)]
    df = spark.createDataFrame(data, "symbol string, trade_date int, opt_right string, exp int, implied_vol double")
    assert rows(ivchain.peak_expirations(df), "trade_date", "exp") == [(8, 2), (9, 4)]


def test_chain_ends_at_the_horizon(spark, rows):
    df = spark.createDataFrame([(20240110, e) for e in (20240109, 20240110, 20240409, 20240410)], "trade_date int, exp int")
    assert rows(ivchain.in_horizon(df), "exp") == [(20240110,), (20240409,)]


def test_missing_leg_interest_stays_separate(spark, rows):
    df = spark.createDataFrame([("A", 1, 10, 20)], "symbol string, strike_milli int, exp_front int, exp_back int")
    oi = spark.createDataFrame([("A", 1, 10, 7)], "symbol string, strike_milli int, exp int, open_interest int")
    got = legs.join_open_interest(df, oi, oi, ["symbol", "strike_milli"])
    assert rows(got, "open_interest_front", "open_interest_back") == [(7, None)]


def test_strike_with_one_right_is_dropped(spark, rows):
    df = spark.createDataFrame([(1, "P", 2.0), (1, "C", 3.0), (2, "C", 4.0)], "strike_milli int, opt_right string, bid double")
    assert rows(legs.widen_put_call(df, ["strike_milli"]), "strike_milli", "bid_P", "bid_C") == [(1, 2.0, 3.0)]
    assert rows(legs.join_put_call(df, ["strike_milli"]), "strike_milli", "bid_P", "bid_C") == [(1, 2.0, 3.0)]


def test_pairs_are_ordered_and_short(spark, rows):
    df = spark.createDataFrame([(1, e) for e in (20240119, 20240126, 20240129, 20240202)], "strike_milli int, exp int")
    got = rows(legs.calendar_pairs(df, ["strike_milli"], 10), "exp", "exp_G1")
    assert got == [(20240119, 20240126), (20240126, 20240129), (20240126, 20240202), (20240129, 20240202)]


def test_single_leg_passes_through(spark):
    df = spark.createDataFrame([(1, 2.0)], "strike_milli int, bid double")
    assert legs.fold_legs({"front": df}, ["strike_milli"]).columns == ["strike_milli", "bid"]
    with pytest.raises(ValueError):
        legs.leg_slice(df, "middle", F.lit(1), "quotes")


def test_upper_median(spark):
    assert one(spark, filters.upper_median(F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4)))) == 3
    assert one(spark, filters.upper_median(F.array(F.lit(1), F.lit(2), F.lit(3)))) == 2


def test_result_gate_needs_six_dates(spark, rows):
    df = spark.createDataFrame([(k, d) for k, n in ((1, 5), (2, 6)) for d in range(n)], "k int, trade_date int")
    assert {r[0] for r in rows(filters.enough_dates(df, ["k"]), "k")} == {2}


def test_type_inference(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "2024-01-02", "x", "7", 2.0), ("2", "2", "False", "2024-01-03", "1", None, 3.0)],
        "i string, d string, b string, t string, s string, gap string, f double",
    )
    assert plan_types(df) == {"i": "bigint", "d": "double", "b": "boolean", "t": "timestamp", "s": "string", "gap": "double", "f": "bigint"}
    assert infer_types(df, skip=("i",)).schema["i"].dataType.simpleString() == "string"


def test_matthews_undefined_is_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    assert matthews(df, "y", "p").first().mcc == 0.0
    mixed = spark.createDataFrame([(1, 1), (0, 0), (0, 1), (1, 0), (1, 1)], "y int, p int")
    assert math.isclose(matthews(mixed, "y", "p").first().mcc, (2 * 1 - 1) / math.sqrt(3 * 3 * 2 * 2))


def test_feature_contract(spark):
    assert len(MODEL_FEATURES) == len(set(MODEL_FEATURES)) == 129
    assert missing_features(spark.createDataFrame([(1,)], "weeks int"), ["weeks", "sector"]) == ["sector"]


def test_dataset_key(spark):
    df = spark.createDataFrame([("A", 2, "2023Q4")], "symbol string, weeks int, fQuarter string")
    assert df.select(planning.dataset_key("C").alias("k")).first().k == "calendar_C_2_weeks/A/A_2023Q4"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, rows, how):
    facts = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i, i * 0.5) for i in range(300)], "k string, i int, v double")
    dim = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, w int")
    plain = rows(facts.join(dim, ["k"], how))
    assert rows(salted_join(facts, dim, ["k"], how)) == plain
    assert rows(salted_join(facts, dim, ["k"], how, hot_keys(facts, ["k"], 8))) == plain


def test_hot_keys_by_share(spark, rows):
    facts = spark.createDataFrame([("hot" if i % 4 else f"k{i % 40}", i) for i in range(400)], "k string, i int")
    assert rows(hot_keys(facts, ["k"], 8)) == [("hot", 6)]
    even = spark.range(400).select((F.col("id") % 8).alias("k"), "id")
    assert rows(hot_keys(even, ["k"], 8)) == []


def test_salting_needs_a_column_to_spread_by(spark):
    facts = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="spread"):
        salted_join(facts, facts, ["k"], hot=hot_keys(facts, ["k"], 8))


def test_joins_without_hot_keys_repeat_nothing(spark):
    plan = salted_join(spark.range(9), spark.range(9), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_joins_broadcast_by_measured_size(spark, tmp_path):
    """A small file of many rows, and rows exploded from it, are no small sides; the limit is the session's own."""
    before = spark.conf.get(session.ESTIMATED)
    try:
        session.tune(spark)
        spark.conf.set(session.ESTIMATED, "200k")
        spark.range(9).selectExpr("0L a").write.parquet(f"{tmp_path}/small")
        small = spark.read.parquet(f"{tmp_path}/small")
        large = small.selectExpr("explode(sequence(1, 20000)) k", "a")

        def plan(dim):
            df = salted_join(spark.range(30_000).selectExpr("cast(id + 20000 as int) k"), dim, ["k"])
            df.collect()
            return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

        assert "BroadcastHashJoin" in plan(large)
        session.broadcast_by_measure(spark)
        session.broadcast_by_measure(spark)
        assert "BroadcastHashJoin" not in plan(large)
        assert "BroadcastHashJoin" in plan(small.selectExpr("cast(a as int) k"))
        session.tune(spark)
        assert spark.conf.get(session.ESTIMATED) == "200k" and spark.conf.get(session.MEASURED, None) is None
    finally:
        spark.conf.set(session.ESTIMATED, before)


def test_listings_of_repeated_and_null_rows(spark):
    rows = [("A", 1, 5, 10), ("A", 1, 5, 10), ("A", 1, 6, None), ("O", 1, None, 11), (None, 1, 7, 12), ("A", 2, 5, 10)]
    listing = ex.contract_listing(spark.createDataFrame(rows, "symbol string, exp int, trade_date int, strike_milli long"))
    got = {(r.symbol, r.exp): (r.trade_dates, r.strikes) for r in listing.collect()}
    assert got == {("A", 1): ([5, 6], [10]), ("A", 2): ([5], [10]), ("O", 1): ([], [11]), (None, 1): ([7], [12])}
    roots = spark.createDataFrame([("A", "A"), ("A", "O"), ("B", "O")], "symbol string, root string")
    named = {(r.symbol, r.exp): (r.trade_dates, r.strikes) for r in ex.listing_of_roots(listing, roots).collect()}
    assert named == {("A", 1): ([5, 6], [10, 11]), ("A", 2): ([5], [10]), ("B", 1): ([], [11])}


def test_salting_splits_a_hot_key(spark):
    hot = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    shares = hot_keys(hot, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.createDataFrame([("hot", 1)], "k string, w int")
        sizes = [r[0] for r in salted_join(hot, dim, ["k"], hot=shares).groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) > 1


def test_attached_totals_and_top_k(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert rows(attach_aggregates(df, ["k"], {"s": F.sum("v")})) == [("a", 1, 3), ("a", 2, 3), ("b", 3, 3)]
    assert rows(top_k(df, ["k"], [F.desc("v")], 1)) == [("a", 2), ("b", 3)]
