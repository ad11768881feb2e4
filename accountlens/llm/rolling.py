"""Running hashes of byte strings in numpy: one prefix sum gives the hash of any range, wherever it stands."""

from __future__ import annotations

import numpy as np

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of the base and of its inverse, modulo 2 to the 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 18)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
                      for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * powers(len(raw))[0], out=total[1:])
    return total


def range_hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end), from the prefix sums of the whole, well mixed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    found = (total[end] - total[start]) * powers(len(total))[1][start]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))
