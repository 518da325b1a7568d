"""Sets of hashes as one bitmap of a fixed size, however many they are."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a set (2 MB); a fuller set only lets more through that isn't in it.
BITS = 1 << 24


def places(hashes: np.ndarray) -> np.ndarray:
    """The bit of each 64-bit hash."""
    return (hashes & np.uint64(BITS - 1)).astype(np.int64)


def bit_set(at: DataFrame):
    """A broadcast bitmap of the bits in column ``at``; what the driver sees of it is BITS / 64 rows at most."""
    bit = F.expr("shiftleft(1L, cast(at % 64 AS int))")
    packed = at.groupBy(F.shiftright("at", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(BITS // 64, np.int64)
    bits[packed["at"].to_numpy()] = packed["bits"].to_numpy()
    return at.sparkSession.sparkContext.broadcast(bits.view(np.uint8))


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set: true for all that are in the set, and for a few others."""
    at = places(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
