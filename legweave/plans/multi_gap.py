"""Multi-gap history: runs of consecutive expirations, all legs in one row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.operators.expirations import (
    contract_listing,
    expiration_runs,
    in_all_groups,
    runs_with_common_days,
    sorted_set,
    within_history,
)
from legweave.operators.filters import enough_dates, strike_corridor
from legweave.operators.gates import Gate, Watch, key_of
from legweave.operators.legs import collapse_duplicates, duplicates_agree, merge, widen_legs
from legweave.market import covered_days, on_days
from legweave.operators.planning import expirations_key, not_in
from legweave.plans.equity_history import reduced
from legweave.schemas import BAR_KEYS
from legweave.scratch import settle
from legweave.skew import salted_join

# Back legs per run, shared trade dates a run needs.
GAPS = 3
MIN_RUN_DATES = 5
CORRIDOR_RIGHT = "C"
RUN_KEYS = ["symbol", "exps"]


def listed_runs(listing: DataFrame, gaps: int = GAPS, min_dates: int = MIN_RUN_DATES) -> DataFrame:
    """Runs of consecutive expirations with enough shared dates, and the ``filepath`` of each as a unit of work."""
    days = listing.select("symbol", "exp", F.explode("trade_dates").alias("trade_date"))
    runs = runs_with_common_days(expiration_runs(days, gaps + 1), days, min_dates)
    return runs.withColumn("filepath", expirations_key("symbol", "exps"))


def run_plan(listing: DataFrame, runs: DataFrame, greeks: DataFrame, gaps: int = GAPS) -> DataFrame:
    """Runs with their shared dates, shared strikes and corridor; the quotes' listing is all that is read of them."""
    listed = listing.select("symbol", "exp", F.explode("strikes").alias("strike_milli"))
    legs = runs.select(*RUN_KEYS, F.explode("exps").alias("exp"))
    shared = in_all_groups(
        salted_join(listed, legs, ["symbol", "exp"]), RUN_KEYS, "strike_milli", "exp", gaps + 1
    )
    strikes = shared.groupBy(*RUN_KEYS).agg(sorted_set("strike_milli").alias("strikes"))
    plan = runs.drop("filepath").join(strikes, RUN_KEYS).withColumns(
        {"exp_front": F.get("exps", F.lit(0)), "trade_dates": F.array("first_day", "last_day")}
    )
    # The corridor reads the plan twice, so it is written once.
    plan = settle(plan, "run-plan")
    return strike_corridor(plan, on_days(greeks, covered_days(plan, "first_day", "last_day")), RUN_KEYS, CORRIDOR_RIGHT)


def leg_names(gaps: int) -> list[str]:
    return ["front", *[f"back_G{g}" for g in range(1, gaps + 1)]]


def leg_columns(gaps: int) -> list[str]:
    """Suffixes of the legs' columns: puts, then calls."""
    return [f"{r}_{n}" for r in ("P", "C") for n in leg_names(gaps)]


def one_underlying(gaps: int) -> dict[str, list[str]]:
    """The underlyings of all legs, of which that of the front put is kept."""
    return {"underlying": [f"underlying_{n}" for n in leg_columns(gaps)]}


def agreement_watch(gaps: int = GAPS) -> Watch:
    """Counts the bars whose legs report different underlyings."""
    key = key_of("symbol", "trade_date", "ms_of_day", "strike_milli")
    return Watch([Gate("underlying_differs", ~duplicates_agree(one_underlying(gaps)), key)])


def multi_gap_history(
    quotes: DataFrame, greeks: DataFrame, gaps: int = GAPS, watch: Watch | None = None, strict: bool = False
) -> DataFrame:
    """Quotes and greeks of all legs and both rights per strike and bar.

    Every leg of every run is looked up in one pass over the bars, then the legs
    are put side by side by one aggregation.  Runs with five trade dates or
    fewer give nothing.  Legs may report different underlyings: ``watch`` (an
    :func:`agreement_watch`) counts them, and with ``strict`` they are an error.
    """
    listing = settle(contract_listing(quotes), "listing")
    return _history_of(listing, listed_runs(listing, gaps), quotes, greeks, gaps, watch, strict).drop("filepath")


@dataclass(frozen=True)
class MultiGapRun:
    """What a run of the job has made, and the ``filepath`` of the units that gave nothing."""

    rows: DataFrame
    failures: DataFrame


def multi_gap_run(
    quotes: DataFrame,
    greeks: DataFrame,
    done: DataFrame,
    first_day: int,
    last_day: int,
    gaps: int = GAPS,
    watch: Watch | None = None,
) -> MultiGapRun:
    """The job over trade dates strictly between the two days, of expirations before the last.

    Units whose ``filepath`` is in ``done`` (existing outputs and the ledger of
    failures) are skipped; rows carry the ``filepath`` of theirs.
    """
    quotes, greeks = (within_history(t, first_day, last_day) for t in (quotes, greeks))
    listing = settle(contract_listing(quotes), "listing")
    units = settle(not_in(listed_runs(listing, gaps), done, ["filepath"]), "units")
    rows = _history_of(listing, units, quotes, greeks, gaps, watch, False)
    failures = not_in(units, rows.select("filepath").distinct(), ["filepath"]).select("filepath")
    return MultiGapRun(rows, failures)


def _history_of(
    listing: DataFrame, runs: DataFrame, quotes: DataFrame, greeks: DataFrame, gaps: int, watch: Watch | None, strict: bool
) -> DataFrame:
    watch = watch or agreement_watch(gaps)
    plan = run_plan(listing, runs, greeks, gaps)
    names = F.array(*[F.lit(n) for n in leg_names(gaps)])
    wanted = plan.select(
        *RUN_KEYS,
        "strikes",
        "first_day",
        "last_day",
        F.posexplode("exps").alias("__leg", "exp"),
    ).select(
        *RUN_KEYS,
        "exp",
        "first_day",
        "last_day",
        F.get(names, F.col("__leg")).alias("__name"),
        F.explode("strikes").alias("strike_milli"),
    )
    wanted = settle(wanted, "wanted")
    contracts = settle(
        wanted.groupBy("symbol", "exp", "strike_milli").agg(
            F.min("first_day").alias("from_day"), F.max("last_day").alias("to_day")
        ),
        "contracts",
    )
    days = contracts.agg(F.min("from_day").alias("first"), F.max("to_day").alias("last")).first()  # one row
    first, last = days.first or 0, days.last or 0
    # Both tables are cut to the wanted contracts and days before they meet.
    wanted_days = covered_days(contracts, "from_day", "to_day")
    quoted, greek = (reduced(t, contracts, first, last, wanted_days) for t in (quotes, greeks.drop("bid", "ask")))
    bars = merge(quoted, greek, BAR_KEYS)
    rows = salted_join(bars, wanted, ["symbol", "exp", "strike_milli"]).filter(
        F.col("trade_date").between(F.col("first_day"), F.col("last_day"))
    )
    cells = rows.withColumn("__cell", F.concat_ws("_", "opt_right", "__name"))
    values = [n for n in bars.columns if n not in BAR_KEYS and n != "underlying"]
    keys = [*RUN_KEYS, "strike_milli", "trade_date", "ms_of_day"]
    wide = watch.on(widen_legs(cells, keys, "__cell", leg_columns(gaps), [*values, "underlying"]))
    wide, _ = collapse_duplicates(wide, one_underlying(gaps))
    exps = {f"exp_{n}": F.get("exps", F.lit(i)) for i, n in enumerate(leg_names(gaps))}
    exps["filepath"] = expirations_key("symbol", "exps")
    result = enough_dates(wide, RUN_KEYS).withColumns(exps)
    if strict:
        watch.require()
    return result
