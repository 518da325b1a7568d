"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNFACTOR = np.uint64(pow(int(FACTOR), -1, 1 << 64))
MIXER = np.uint64(0xBF58476D1CE4E5B9)
# Signs that are hashed at a time: the running sums take some fifty bytes for each.
SPAN = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all of it."""
    x = (x ^ (x >> np.uint64(30))) * MIXER
    return x ^ (x >> np.uint64(29))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def range_hashes(signs: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The rolling hash of ``signs[first[i]:last[i]]`` of every i; the ranges are in order and none is empty."""
    out = np.empty(len(first), np.uint64)
    lo = 0
    while lo < len(first):
        base = first[lo]
        hi = max(lo + 1, int(np.searchsorted(last, base + SPAN, "right")))
        part = signs[base : last[hi - 1]]
        total = np.append(np.uint64(0), np.cumsum((part + np.uint64(1)) * _powers(FACTOR, len(part))))
        begin, end = first[lo:hi] - base, last[lo:hi] - base
        out[lo:hi] = (total[end] - total[begin]) * _powers(UNFACTOR, len(part))[begin]
        lo = hi
    return out


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, lower-cased in ASCII, and where each document's words start; words end at documents."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = inside & (edge[:-1] | np.append(True, ~inside[:-1]))
    stops = inside & (edge[1:] | np.append(~inside[1:], True))
    first, last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = range_hashes(LOWER[data], first, last)
    return mixed(hashes + (last - first).astype(np.uint64)), np.searchsorted(first, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each document's set starts, and all sets end to end, each sorted without repeats.

    A shingle is ``size`` words; a document with fewer has all its words as one
    shingle, and none without words.
    """
    hashes, at = words(data, starts)
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        rolled = mixed(rolled * FACTOR + hashes[k : k + len(rolled)])
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            one = np.sort(rolled[a : b - size + 1])
            sets.append(one[np.append(True, one[1:] != one[:-1])])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                whole = mixed(whole * FACTOR + hashes[k])
            sets.append(whole)
        else:
            sets.append(hashes[:0])
    ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)
    return ends, np.concatenate(sets) if sets else hashes[:0]
