"""Interval bars: the last value of each key and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATERMARK = "30 minutes"


def interval_bars(
    ticks: DataFrame, keys: list[str], value: str, order: list[str], ivl_ms: int, watermark: str | None = None
) -> DataFrame:
    """Last ``value`` (by ``order``) per key and interval of ``ts``.

    The same plan serves a table and a stream; on a stream, rows later than the
    watermark are dropped and left to the batch job to correct.
    """
    if watermark is not None:
        ticks = ticks.withWatermark("ts", watermark)
    bar = F.window("ts", f"{ivl_ms // 1000} seconds")
    return (
        ticks.groupBy(*keys, bar.alias("bar"))
        .agg(F.max_by(value, F.struct(*order)).alias(value), F.count("*").alias("ticks"))
        .select(*keys, F.unix_timestamp("bar.start").alias("bar_start"), value, "ticks")
    )
