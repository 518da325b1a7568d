"""Bars of a stream whose rows may come late: what is behind the watermark is kept apart, and its bars rebuilt."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.functions.dates import to_yyyymmdd
from legweave.sinks.writers import append_run
from legweave.sources.tables import exists
from legweave.streaming import runner
from legweave.streaming.bars import interval_bars

DELAY_SECONDS = 1_800


class LateBars:
    """Interval bars of a tick stream below one folder: ticks, closed bars, and corrections.

    Ticks are landed once, by whether they are late, their day and the
    micro-batch that brought them.  A tick is late when its bar had ended more
    than the delay before the newest tick of the earlier batches: then the bar
    may have been given out.  On-time ticks feed a stream of bars with the same
    delay as its watermark, which therefore drops none of them.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], value: str, order: Sequence[str], ivl_ms: int):
        self.spark, self.root = spark, root
        self.keys, self.value, self.order, self.ivl_ms = list(keys), value, list(order), ivl_ms

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _frontier(self, batch_id: int) -> int | None:
        """Epoch second of the newest tick of all earlier batches."""
        if not exists(self.spark, self.path("frontier")):
            return None
        log = self.spark.read.schema("newest long, run long").parquet(self.path("frontier"))
        return log.filter(F.col("run") < batch_id).agg(F.max("newest")).first()[0]  # one row per batch

    def _land(self) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            before = self._frontier(batch_id)
            seconds = self.ivl_ms // 1000
            ends = (F.floor(F.unix_timestamp("ts") / seconds) + 1) * seconds
            late = (F.lit(False) if before is None else ends <= before - DELAY_SECONDS).cast("int")
            seen = Observation(f"newest-{uuid.uuid4().hex}")
            flagged = batch.withColumns(
                {"late": late, "day": to_yyyymmdd("ts"), "batch": F.lit(batch_id).cast("long")}
            ).observe(seen, F.max(F.unix_timestamp("ts")).alias("newest"))
            # Repeating a batch replaces its folders, and its line of the frontier.
            flagged.write.partitionBy("late", "day", "batch").mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).parquet(self.path("ticks"))
            newest = seen.get["newest"]
            if newest is not None:
                append_run(self.spark.createDataFrame([(newest,)], "newest long"), self.path("frontier"), batch_id)

        return write

    def catch_up(self, ticks: DataFrame) -> None:
        """Lands what the tick stream has, and gives out the bars that it closes."""
        runner.catch_up_batches(ticks, self._land(), self.path("landing-state"), "append")
        schema = T.StructType([*ticks.schema.fields, T.StructField("day", T.IntegerType()), T.StructField("batch", T.LongType())])
        on_time = runner.stream_files(self.spark, self.path("ticks") + "/late=0", schema)
        bars = interval_bars(
            on_time.drop("day", "batch"), self.keys, self.value, self.order, self.ivl_ms, f"{DELAY_SECONDS} seconds"
        )
        runner.catch_up(bars, self.path("bars"), self.path("bars-state"))

    def correct(self) -> DataFrame:
        """Rebuilds the bars that late ticks touch, from all ticks of those bars; returns them.

        Only the touched days are read and replaced, so correcting again, with
        or without new late ticks, leaves the same table.
        """
        ticks = self.spark.read.parquet(self.path("ticks"))
        bar = F.floor(F.unix_timestamp("ts") / (self.ivl_ms // 1000)) * (self.ivl_ms // 1000)
        placed = ticks.withColumn("bar_start", bar)
        touched = placed.filter(F.col("late") == 1).select("day", *self.keys, "bar_start").distinct()
        again = placed.join(touched, ["day", *self.keys, "bar_start"], "left_semi")
        rebuilt = interval_bars(again, self.keys, self.value, self.order, self.ivl_ms)
        rebuilt.withColumn("day", to_yyyymmdd(F.timestamp_seconds("bar_start"))).write.partitionBy("day").mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").parquet(self.path("corrections"))
        return self.spark.read.schema(rebuilt.schema).parquet(self.path("corrections")).select(*rebuilt.columns)

    def bars(self) -> DataFrame:
        """Closed bars: those of the stream, with the corrected ones in their place."""
        closed = self.spark.read.parquet(self.path("bars"))
        if not exists(self.spark, self.path("corrections")):
            return closed
        fixed = self.spark.read.parquet(self.path("corrections")).select(*closed.columns)
        return closed.join(fixed, [*self.keys, "bar_start"], "left_anti").unionByName(fixed)
