"""Index history: quotes, greeks and open interest of every (expiration, day) that is still to be stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legweave.market import on_days
from legweave.operators.expirations import expires_on_trading_day
from legweave.operators.planning import due_slices
from legweave.scratch import settle
from legweave.sinks.writers import append_run, write_partitioned
from legweave.sources.tables import delete, exists

DATASETS = ("greeks", "open_interest", "quotes")
UNIT = ["symbol", "exp", "trade_date"]
MARK = f"{', '.join(f'{k} {t}' for k, t in zip(UNIT, ('string', 'int', 'int'), strict=True))}, dataset string"


@dataclass(frozen=True)
class HistoryStore:
    """The three datasets of one feed (a bar interval and its hours), their commits and their failures.

    Rows lie by run and trade date.  They count only once the run's commits name
    their unit, so what a run that died has left is never read, and repeating
    the run replaces it.
    """

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def marks(self, spark: SparkSession, name: str) -> DataFrame:
        """(unit, dataset, run) of the ``commits`` or of the ledger of ``failures``."""
        path = self.path(name)
        if not exists(spark, path):
            return spark.createDataFrame([], f"{MARK}, run long")
        return spark.read.schema(f"{MARK}, run long").parquet(path)

    def rows(self, spark: SparkSession, dataset: str) -> DataFrame:
        """The committed rows of a dataset."""
        commits = self.marks(spark, "commits").filter(F.col("dataset") == dataset).select(*UNIT, "run")
        return spark.read.parquet(self.path(dataset)).join(commits, [*UNIT, "run"], "left_semi").drop("run")

    def settled(self, spark: SparkSession) -> DataFrame:
        """Units that need no more work: stored, or failed in an earlier run."""
        names = ("commits", "failures")
        done = [self.marks(spark, n).select(*UNIT, "dataset") for n in names]
        return done[0].unionByName(done[1]).distinct()


def wanted_units(days: DataFrame, limits: DataFrame, first_exp: int, last_day: int) -> DataFrame:
    """The last trade dates of the expirations that trade on their own day, as many as the symbol's limit.

    ``days`` lists (symbol, exp, trade_date), ``limits`` has (symbol, max_days).
    Expirations are later than ``first_exp``; dates after ``last_day`` count
    towards the limit but are left for a later run.
    """
    own = expires_on_trading_day(days.select(*UNIT).distinct().filter(F.col("exp") > first_exp))
    newest = Window.partitionBy("symbol", "exp").orderBy(F.desc("trade_date"))
    placed = own.join(limits.select("symbol", "max_days"), "symbol").withColumn("__nth", F.row_number().over(newest))
    return placed.filter((F.col("__nth") <= F.col("max_days")) & (F.col("trade_date") <= last_day)).select(*UNIT)


def complete_units(quotes: DataFrame, greeks: DataFrame) -> DataFrame:
    """Units whose greeks have both rights of every quoted strike."""
    quoted = quotes.select(*UNIT, "strike_milli").distinct().groupBy(*UNIT).agg(F.collect_set("strike_milli").alias("want"))
    held = greeks.groupBy(*UNIT).agg(
        *[F.collect_set(F.when(F.col("opt_right") == r, F.col("strike_milli"))).alias(r) for r in ("P", "C")]
    )
    lacking = [F.size(F.array_except("want", r)) == 0 for r in ("P", "C")]
    return quoted.join(held, UNIT).filter(lacking[0] & lacking[1]).select(*UNIT)


def store_index_history(
    spark: SparkSession,
    days: DataFrame,
    tables: dict[str, DataFrame],
    limits: DataFrame,
    store: HistoryStore,
    run: int,
    first_exp: int,
    last_day: int,
) -> DataFrame:
    """Stores what is due and returns (unit, dataset, status): committed, failed or absent.

    ``tables`` has the landed market table of each of DATASETS; of tables
    partitioned by trade date only the due days are read.  A unit is due while
    any dataset of it is neither stored nor failed, and only these are written.
    It fails when it has no quotes, or when its greeks lack a right of a quoted
    strike: then nothing of it is stored and it goes to the ledger.  Open
    interest may be absent; it stays due for the next run.
    """
    wanted = wanted_units(days, limits, first_exp, last_day)
    due = settle(due_slices(wanted, store.settled(spark), DATASETS), "due")
    units = due.select(*UNIT).distinct()
    cut = {}
    for dataset in DATASETS:
        # The completeness of greeks is judged by the quotes, so these are read for every due unit.
        of = units if dataset == "quotes" else due.filter(F.col("dataset") == dataset).select(*UNIT)
        cut[dataset] = on_days(tables[dataset], of).join(of, UNIT, "left_semi")
    need_greeks = due.filter(F.col("dataset") == "greeks").select(*UNIT)
    complete = complete_units(cut["quotes"], cut["greeks"])
    quoted = cut["quotes"].select(*UNIT).distinct()
    whole = units.join(need_greeks, UNIT, "left_anti").join(quoted, UNIT, "left_semi").unionByName(complete)
    whole = settle(whole, "whole")
    for dataset in DATASETS:
        ready = whole.join(due.filter(F.col("dataset") == dataset).select(*UNIT), UNIT, "left_semi")
        rows = cut[dataset].join(ready, UNIT, "left_semi").withColumn("run", F.lit(run).cast("long"))
        path = store.path(dataset)
        delete(spark, f"{path}/run={run}")  # what an earlier try of this run has left
        write_partitioned(rows, path, ["run", "trade_date"], sort=["symbol", "exp", "strike_milli"])
    # The commit: until this one write is done, none of the run's rows count.
    stored = []
    for dataset in DATASETS:
        written = spark.read.schema(f"{MARK.removesuffix(', dataset string')}, run long").parquet(store.path(dataset))
        stored.append(written.filter(F.col("run") == run).select(*UNIT, F.lit(dataset).alias("dataset")).distinct())
    stored = settle(stored[0].unionByName(stored[1]).unionByName(stored[2]), "stored")
    failed = due.join(whole, UNIT, "left_anti")
    append_run(failed, store.path("failures"), run)
    append_run(stored, store.path("commits"), run)
    status = F.when(F.col("__stored"), "committed").when(F.col("__failed"), "failed").otherwise("absent")
    report = due.join(stored.withColumn("__stored", F.lit(True)), [*UNIT, "dataset"], "left")
    report = report.join(failed.withColumn("__failed", F.lit(True)), [*UNIT, "dataset"], "left")
    return report.select(*UNIT, "dataset", status.alias("status"))
