"""Arrow columns as flat numpy arrays, and documents cut into blocks of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that one numpy step works on at a time; a longer document is a block of its own.
BLOCK_BYTES = 2_000_000
# Documents of such a step at most, so that what is held per document is bounded too.
BLOCK_ROWS = 1_024


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes end to end, and each row's start; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def blocks(starts: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most BLOCK_ROWS rows whose bytes stay within ``limit``, one row at least."""
    lo, rows = 0, len(starts) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + limit, "right")) - 1)
        hi = min(hi, rows, lo + BLOCK_ROWS)
        yield lo, hi
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def give_back() -> None:
    """Returns to the system what freed arrays have left in this process: a worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """``values`` at :func:`ragged`'s positions, ``step`` ranges at a time, as positions take more room than values."""
    at = range(0, len(starts), step)
    parts = [values[ragged(starts[lo : lo + step], lengths[lo : lo + step])] for lo in at]
    return np.concatenate(parts) if parts else values[:0]


def list_column(starts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from each row's start in ``values``."""
    return pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), values)
