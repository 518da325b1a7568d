"""Latest state per key, versioned appends and incremental backfill."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.sinks.writers import append_alerts


def latest_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The values of each key at its largest version (table or stream)."""
    newest = F.max_by(F.struct(*version, *values), F.struct(*version)).alias("__row")
    names = [*version, *values]
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__row.{n}").alias(n) for n in names])


def upsert_log(path: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that keeps each batch's updates as its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_alerts(batch, path, batch_id)

    return write
