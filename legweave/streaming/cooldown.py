"""Alert cooldown: at most one alert per key in any hour after an emitted one.

The gap is measured from the last *emitted* alert of the same day, so the rule
is sequential within (symbol, weeks, day).  Alerts in the same second as an
earlier one can never be emitted, so a key's day reduces to its distinct seconds
(86,400 at most) before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from legweave.operators.alerts import COOLDOWN_SECONDS

COOLDOWN_KEYS = ["symbol", "weeks", "alert_date"]
EMITTED = "symbol string, weeks int, alert_date int, alert_time bigint, event_id bigint"

# The last emitted time of a day is never needed again once the day is over.
STATE_TTL_MS = 30 * 24 * 3600 * 1000


def replay_cooldown(alerts: DataFrame, seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """The alerts that a run over the whole table emits.

    Per key and day the distinct seconds are folded in order inside the JVM.
    """
    per_second = alerts.groupBy(*COOLDOWN_KEYS, "alert_time").agg(F.min("event_id").alias("event_id"))
    days = per_second.groupBy(*COOLDOWN_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("alert_time", "event_id"))).alias("tries")
    )
    nothing = F.expr("cast(array() as array<struct<alert_time: bigint, event_id: bigint>>)")
    emitted = F.aggregate(
        "tries",
        nothing,
        lambda kept, t: F.when(
            (F.size(kept) == 0)
            | F.coalesce(
                t["alert_time"] - F.try_element_at(kept, F.lit(-1))["alert_time"] > F.lit(seconds), F.lit(False)
            ),
            F.concat(kept, F.array(t)),
        ).otherwise(kept),
    )
    return days.select(*COOLDOWN_KEYS, F.explode(emitted).alias("e")).select(
        *COOLDOWN_KEYS, "e.alert_time", "e.event_id"
    )


class CooldownProcessor(StatefulProcessor):
    """Remembers the last emitted alert time of a key; forgets it after the TTL."""

    def __init__(self, seconds: int = COOLDOWN_SECONDS, ttl_ms: int = STATE_TTL_MS):
        self.seconds = seconds
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "alert_time bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first_at: dict[int, int] = {}
        for pdf in rows:
            firsts = pdf.groupby("alert_time")["event_id"].min()
            for t, event in zip(firsts.index.tolist(), firsts.tolist()):
                if t not in first_at or event < first_at[t]:
                    first_at[t] = event
        last = self.last.get()[0] if self.last.exists() else None
        emitted = []
        for t in sorted(first_at):
            if last is None or t - last > self.seconds:
                emitted.append((*key, t, first_at[t]))
                last = t
        if emitted:
            self.last.update((last,))
        yield pd.DataFrame(emitted, columns=[*COOLDOWN_KEYS, "alert_time", "event_id"])

    def close(self) -> None:
        pass


def cooldown_stream(alerts: DataFrame, seconds: int = COOLDOWN_SECONDS, ttl_ms: int = STATE_TTL_MS) -> DataFrame:
    """:func:`replay_cooldown` on a stream of alert attempts."""
    return alerts.groupBy(*COOLDOWN_KEYS).transformWithStateInPandas(
        statefulProcessor=CooldownProcessor(seconds, ttl_ms),
        outputStructType=EMITTED,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
