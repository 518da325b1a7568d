"""The alert cooldown under event time: exact for attempts out of order, with timers that end each key's day."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from legweave.operators.alerts import COOLDOWN_SECONDS
from legweave.sinks.writers import RETENTION_DAYS
from legweave.sources.tables import delete, manifest
from legweave.streaming.cooldown import COOLDOWN_KEYS, EMITTED

DELAY_SECONDS = 1_800


def seconds_of(alert_time: int) -> int:
    """Milliseconds at which no attempt of the second ``alert_time`` can arrive any more, once the watermark is there."""
    return (alert_time + 1) * 1000


def end_of_day(alert_date: int) -> int:
    """Milliseconds at which the UTC day ``alert_date`` (yyyymmdd) is over."""
    day = datetime.datetime.strptime(str(alert_date), "%Y%m%d").replace(tzinfo=datetime.timezone.utc)
    return int((day + datetime.timedelta(days=1)).timestamp()) * 1000


class DayCooldownProcessor(StatefulProcessor):
    """Holds a key's attempts until the watermark has passed them, then settles them in order.

    The state is the last emitted second and the open attempts, one per second.
    A timer stands at the first open attempt, and another at the end of the day,
    which removes the key.
    """

    def __init__(self, seconds: int = COOLDOWN_SECONDS):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "alert_time bigint")
        self.open = handle.getValueState("open", "times array<bigint>, events array<bigint>")

    def _attempts(self) -> dict[int, int]:
        if not self.open.exists():
            return {}
        times, events = self.open.get()
        return dict(zip(times, events, strict=True))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts = self._attempts()
        before = min(attempts, default=None)
        for pdf in rows:
            firsts = pdf.groupby("alert_time")["event_id"].min()
            for t, event in zip(firsts.index.tolist(), firsts.tolist(), strict=True):
                attempts[t] = min(event, attempts.get(t, event))
        self.open.update((list(attempts), list(attempts.values())))
        first = min(attempts)
        if before is None or first < before:
            self.handle.registerTimer(seconds_of(first))
        self.handle.registerTimer(end_of_day(int(key[2])))
        yield pd.DataFrame([], columns=[*COOLDOWN_KEYS, "alert_time", "event_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        attempts = self._attempts()
        last = self.last.get()[0] if self.last.exists() else None
        emitted = []
        closed = sorted(t for t in attempts if seconds_of(t) <= watermark)
        for t in closed:
            event = attempts.pop(t)
            if last is None or t - last > self.seconds:
                emitted.append((*key, t, event))
                last = t
        if not attempts and end_of_day(int(key[2])) <= watermark:
            self.open.clear()
            self.last.clear()
        elif closed:
            self.last.update((last,))
            if attempts:
                self.open.update((list(attempts), list(attempts.values())))
                self.handle.registerTimer(seconds_of(min(attempts)))
            else:
                self.open.clear()
        yield pd.DataFrame(emitted, columns=[*COOLDOWN_KEYS, "alert_time", "event_id"])

    def close(self) -> None:
        pass


def day_cooldown_stream(
    alerts: DataFrame, delay_seconds: int = DELAY_SECONDS, seconds: int = COOLDOWN_SECONDS
) -> DataFrame:
    """:func:`replay_cooldown` on a stream of attempts that come out of order by up to ``delay_seconds``.

    ``alerts`` need ``ts``, the event time of ``alert_time``, whose UTC date is
    ``alert_date``.  An alert is given out once the watermark has passed its
    second, so it never depends on the order of arrival; attempts behind the
    watermark are dropped.  A key holds nothing once its day is behind the
    watermark, so the state is as large as the days that are open.  Rows without
    a time, a date or an event id are dropped.
    """
    usable = alerts.dropna(subset=["ts", "alert_time", "alert_date", "event_id"])
    return usable.withWatermark("ts", f"{delay_seconds} seconds").groupBy(*COOLDOWN_KEYS).transformWithStateInPandas(
        statefulProcessor=DayCooldownProcessor(seconds),
        outputStructType=EMITTED,
        outputMode="Append",
        timeMode="EventTime",
    )


def retaining_sink(spark: SparkSession, path: str, days: int = RETENTION_DAYS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of alerts by day that removes what has grown old, in the same run.

    A batch's rows lie in folders of their own, which a repeated batch replaces.
    Once they are written, the days that lie more than ``days`` before the newest
    day of the sink are deleted; nothing is rewritten.  So the sink never holds
    more than ``days`` + 1 days after a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id).cast("long"))
            .write.partitionBy("alert_date", "batch")
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(path)
        )
        for day in expired_days(spark, path, days):
            delete(spark, f"{path}/alert_date={day}")

    return write


def expired_days(spark: SparkSession, path: str, days: int) -> list[int]:
    """The days of a sink that lie more than ``days`` before its newest one; a sink has one row per day to read."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/alert_date=*")
    if not pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
        return []  # no batch has had rows yet
    held = manifest(spark, path, ["alert_date"])
    day = F.to_date(F.col("alert_date").cast("string"), "yyyyMMdd")
    newest = held.agg(F.max(day).alias("newest"))  # one row
    old = held.join(F.broadcast(newest), F.date_diff("newest", day) > days)
    return [r.alert_date for r in old.select("alert_date").collect()]
