"""Hashed words and character n-grams of a text, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from accountlens.llm.rolling import prefix_sums, range_hashes

#: Characters or words hashed at a time; limits memory for a very long text.
CHUNK = 1 << 17

_FACTORS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 8, np.uint64) | np.uint64(1)


def buckets(text: bytes, sizes: tuple[int, ...], bits: int, repeats: bool = False) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of the given sizes, and of the words behind them, in chunks.

    White space is one boundary mark. An n-gram may start or end with a mark but has none inside. Words have
    the buckets from ``2 ** bits`` on. With ``repeats``, a word equal to the one before it adds the bucket
    ``2 ** (bits + 1)``, once for each of its bytes, so that the mark weighs as much as its n-grams.
    """
    joined = b" ".join(text.split())
    if not joined:
        return
    marked = np.frombuffer((" " + joined.decode("utf-8", "replace") + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    shift = np.uint64(64 - bits)
    for n in sizes:
        for begin in range(0, len(marked) - n + 1, CHUNK):
            part = marked[begin:begin + CHUNK + n - 1]
            m = len(part) - n + 1
            code, inside = np.full(m, _FACTORS[8 - n]), np.ones(m, bool)
            for k in range(n):
                code ^= code >> np.uint64(32)
                code = (code + part[k:k + m]) * _FACTORS[k]
                if 0 < k < n - 1 or n == 1:
                    inside &= part[k:k + m] != 32
            yield (code[inside] >> shift).astype(np.int64)
    raw = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]])
    last = np.zeros(0, np.uint64)
    for begin in range(0, len(starts), CHUNK):
        a, b = starts[begin:begin + CHUNK], ends[begin:begin + CHUNK]
        total = prefix_sums(raw[a[0]:b[-1]])
        code = range_hashes(total, a - a[0], b - a[0])
        yield (code >> shift).astype(np.int64) + (1 << bits)
        if repeats:
            same = np.concatenate([last, code[:-1]]) == code[1 - len(last):]
            yield np.full(int((b - a)[1 - len(last):][same].sum()), 2 << bits, np.int64)
            last = code[-1:]
