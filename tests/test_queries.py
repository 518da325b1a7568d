"""Registered queries against DuckDB, and the shape of key plans."""

import importlib.util
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from legweave import catalog

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("check", ROOT / "tools" / "check.py")
check = importlib.util.module_from_spec(spec)
sys.modules["check"] = check
spec.loader.exec_module(check)

LIBRARY = sorted(catalog.REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in LIBRARY if catalog.REGISTRY[n].sql])
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    mine = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = check.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert mine == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_and_oracles():
    names = set(entry.queries())
    assert set(LIBRARY) <= names and set(entry.oracle_sql()) <= names
    assert set(LIBRARY) <= set(entry.oracle_sql())


def test_history_cuts_tables_before_they_meet(spark):
    """Below the join of quotes and greeks each side has been joined to the wanted contracts, and is read once."""
    from legweave.plans import equity_history as eh

    contracts = spark.createDataFrame([("A", 1, 1, 1, 2)], "symbol string, exp int, strike_milli long, from_day int, to_day int")
    columns = "symbol string, opt_right string, strike_milli long, exp int, trade_date int, ms_of_day int"
    tables = [spark.range(5).selectExpr("'A' symbol", "'C' opt_right", "id strike_milli", "1 exp", "1 trade_date", "1 ms_of_day", f"id v{i}") for i in range(2)]
    cut = [eh.reduced(t, contracts, 1, 2) for t in tables]
    plan = cut[0].join(cut[1], eh.BAR_KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 5") == 2 and plan.count("Join Inner") == 3


@pytest.mark.parametrize(("name", "scans"), [("f09_result_gate", 1), ("f10_edge_bars", 2), ("s14_complete_slices", 2)])
def test_filters_read_their_input_once(spark, name, scans):
    """At most one lineitem scan per derived table, and none where the input was written first."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") <= scans


@pytest.mark.parametrize("name", ["j09_calendar_pairs", "j09_recovery_pairs", "j10_front_expiration", "j11_back_expiration", "w08_trend_slice"])
def test_range_rules_stay_equi_joins(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["j09_calendar_pairs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan and "l_returnflag" not in plan
