"""One run of the alerts: the newest scored calendars, the cooldown against the log, and the log itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.functions.dates import EXCHANGE_ZONE, epoch_to_local_day
from legweave.operators import alerts
from legweave.scratch import settle
from legweave.sinks.writers import append_alerts
from legweave.sources.tables import exists

# Fixed value: least grade of a symbol and number of weeks.
LEAST_GRADE = 1.25
GRADE = "undmean_avg_trade_class_combined_grade"
LOGGED = ["symbol", "weeks", "alert_time", "alert_date"]


def selected_alerts(scored: DataFrame, least_grade: float = LEAST_GRADE) -> DataFrame:
    """The best calendar of each symbol and number of weeks in the newest version, with the alert's time and day."""
    newest = alerts.latest_version(scored).filter(F.col(GRADE) >= least_grade)
    kept = alerts.gap_below_limit(alerts.passes_preset(alerts.rounded(newest)))
    return alerts.best_per_key(kept, ["row_id"]).withColumns(
        {"alert_time": F.col("lastUpdated"), "alert_date": epoch_to_local_day("lastUpdated", EXCHANGE_ZONE)}
    )


def read_alert_log(spark: SparkSession, path: str) -> DataFrame:
    """All logged alerts with their run; none before the first run."""
    schema = "symbol string, weeks int, alert_time long, alert_date int, run long"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def run_alerts(spark: SparkSession, scored: DataFrame, log: str, run: int) -> DataFrame:
    """The run's alerts, written to the log at ``log`` once, whatever the number of chats.

    The cooldown is judged by the log of all other runs, so a run that is
    repeated after a crash decides as it did and replaces its own lines.
    """
    earlier = read_alert_log(spark, log).filter(F.col("run") != run)
    fresh = settle(alerts.past_cooldown(selected_alerts(scored), earlier), "alerts")
    append_alerts(fresh.select(*LOGGED), log, run)
    return fresh
