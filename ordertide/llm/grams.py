"""Hashes of byte spans and of runs of units, for whole blocks of texts at once.

All are 64-bit polynomial hashes modulo 2**64 over random values per byte, taken
from prefix sums and mixed. Two different spans collide with a chance of about
2**-64 a pair.
"""

from __future__ import annotations

import numpy as np

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: A random value for each byte; LOWER takes A-Z as a-z.
BYTES = np.random.default_rng(20).integers(1, 2**63, size=256, dtype=np.uint64)
LOWER = BYTES.copy()
LOWER[65:91] = BYTES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def _powers(n: int, way: str) -> np.ndarray:
    if len(_POWERS[way]) < n:
        step = np.full(1 << (n - 1).bit_length(), _BASE if way == "up" else _INVERSE, np.uint64)
        step[0] = 1
        _POWERS[way] = np.cumprod(step)
    return _POWERS[way][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(units: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _powers(len(units), "up"), out=sums[1:])
    return sums


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the unit sequences [start, end)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = _prefix(units)
    return mixed((sums[ends] - sums[starts]) * _powers(len(units) + 1, "down")[starts])


def run_hashes(units: np.ndarray, n: int) -> np.ndarray:
    """Of every ``n`` consecutive units, by start."""
    if len(units) < n:
        return np.zeros(0, np.uint64)
    sums = _prefix(units)
    return mixed((sums[n:] - sums[:-n]) * _powers(len(units), "down")[:len(units) - n + 1])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes other than ASCII white space."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = SPACE[data]
    edges = np.diff(gap.view(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def words_of(texts: list[bytes], values: np.ndarray = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many words each text has."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = word_spans(data)
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return span_hashes(values[data], starts, ends), np.diff(np.searchsorted(starts, at))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    if len(x) < width:
        return x[:0]
    m, have = x, 1
    while have * 2 <= width:
        m = np.minimum(m[:len(m) - have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def blocks(sizes: list[int], most: int):
    """Slices of consecutive items that add up to ``most`` or are one item."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
