"""Landed quotes to a versioned, priced snapshot table, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from legweave.functions.pricing import mark
from legweave.sinks.writers import stamp_version


def priced_snapshots(quotes: DataFrame, version: int) -> DataFrame:
    """Quotes with their mark, stamped with the version of the run."""
    return stamp_version(quotes.withColumn("mark", mark("bid", "ask")), version)
