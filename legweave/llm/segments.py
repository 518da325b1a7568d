"""Whole texts in parts of bounded size, however long a document is."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

from legweave.llm.batches import BLOCK_BYTES, blocks


def byte_set(signs: str) -> np.ndarray:
    """Which of the 256 bytes are among ``signs``."""
    found = np.zeros(256, bool)
    found[list(signs.encode())] = True
    return found


def segments(
    data: np.ndarray,
    starts: np.ndarray,
    stops: Sequence[np.ndarray],
    back: Callable[[np.ndarray, int], int],
    limit: int = BLOCK_BYTES,
    longest: int | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, starts, first row) of blocks of whole documents, and of the parts of documents longer than ``limit``.

    A part ends after the last byte within the limit that is in the first of
    ``stops``, else in the next of them.  ``back(part, kind)`` says how many of
    its last bytes the following part repeats, ``kind`` being the place in
    ``stops`` that it was cut by.  Where no stop is found the part grows until
    there is one; with ``longest`` it is cut at so many bytes, with kind -1.
    """
    for lo, hi in blocks(starts, limit):
        a, b = int(starts[lo]), int(starts[hi])
        if b - a <= limit:
            yield data[a:b], starts[lo : hi + 1] - a, lo
            continue
        done = a  # parts up to here have been given out
        while done < b:
            end, kind = min(done + limit, b), len(stops)
            while end < b and kind == len(stops):
                for kind, table in enumerate(stops):
                    at = np.flatnonzero(table[data[done:end]])
                    if len(at):
                        end = done + int(at[-1]) + 1
                        break
                else:
                    kind = len(stops)
                    if longest is not None and end - done >= longest:
                        end, kind = done + longest, -1
                    else:
                        end = min(b, end + limit, done + (longest or b))
            part = data[a:end]
            yield part, np.array([0, len(part)]), lo
            done, a = end, max(a, end - back(part, kind))
