"""Sharding by jump consistent hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.llm.ordered import running_totals
from legweave.scratch import settle

# Fixed values of the published jump hash: multiplier of its generator, and 2 to the power 31.
MULTIPLIER = np.uint64(2862933555777941757)
SPAN = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key.

    Every key walks its own pseudo-random sequence of jumps and stays where the
    next jump would pass the last shard, so appending a shard only takes keys
    whose next jump lands on it.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    state = keys.astype(np.uint64)
    landed = np.zeros(len(state), np.int64)
    walking = np.arange(len(state))
    while len(walking):
        state[walking] = state[walking] * MULTIPLIER + np.uint64(1)
        roll = (state[walking] >> np.uint64(33)).astype(np.float64) + 1
        ahead = ((landed[walking] + 1) * (SPAN / roll)).astype(np.int64)
        inside = ahead < shards
        walking, ahead = walking[inside], ahead[inside]
        landed[walking] = ahead
    return landed.astype(np.int32)


def shard_of(key: str, shards: int):
    """A column: the shard of a stable key column of any type; null is a key like others."""

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashed in batches:
            yield pd.Series(jump(hashed.to_numpy().view(np.uint64), shards))

    return place(F.xxhash64(F.col(key)))


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's shard by the law ``key``, its slot there, and its shard with one more.

    Columns: the id, ``size`` (UTF-8 bytes plus 1; null has none), ``text_crc32``
    (null as empty), ``law``, ``shard``, ``slot`` (from 0 without gaps, by id),
    ``grown_shard``.  Other columns are ignored.  The id and the number of shards
    alone decide the shard, so rows that repeat an id share it and take
    neighbouring slots.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = settle(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(id_col, shards).alias("shard"),
            shard_of(id_col, shards + 1).alias("grown_shard"),
            F.lit(1).cast("long").alias("__one"),
        ),
        "placed",
    )
    ranked = running_totals(placed, ["shard", id_col, "text_crc32"], ["__one"])
    # At most one row per shard.
    firsts = F.broadcast(settle(ranked.groupBy("shard").agg(F.min("before___one").alias("__first")), "firsts"))
    return ranked.join(firsts, "shard").select(
        id_col, "size", "text_crc32", "law", "shard", (F.col("before___one") - F.col("__first")).alias("slot"), "grown_shard"
    )
