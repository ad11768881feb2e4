"""Plain versions of operators, for small tables, and the fixture that makes such tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest
import xxhash

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A ``documents`` table of the given texts, with ids from 0 on unless they are given."""
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DDL).repartition(3)

    return make


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Least id that each fingerprint reaches; ``prints``: (id, fingerprint)."""
    fps = sorted({p for _, p in prints})
    root = {p: p for p in fps}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return {p: least.get(find(p)) for p in fps}


def plain_repeats(texts, window):
    raws = {i: t.encode() for i, t in texts.items()}
    counts = Counter(r[k:k + window] for r in raws.values() for k in range(len(r) - window + 1))
    out = {}
    for i, r in raws.items():
        gone = bytearray(len(r))
        for k in range(len(r) - window + 1):
            if counts[r[k:k + window]] > 1:
                gone[k:k + window] = b"\x01" * window
        out[i] = bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore")
    return out


def plain_tokens(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def plain_cover(doc, item, shortest):
    """Tokens of ``item`` that the tiles cover, by trying all starts for the longest match each time."""
    seen_d, seen_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and i + n not in seen_i and d + n not in seen_d):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < shortest:
            return total
        seen_i.update(range(i, i + n))
        seen_d.update(range(d, d + n))
        total += n


def plain_leak(doc, item, shortest, part):
    have, want = plain_tokens(doc), plain_tokens(item)
    runs = {tuple(have[k:k + shortest]) for k in range(len(have) - shortest + 1)}
    if not any(tuple(want[k:k + shortest]) in runs for k in range(len(want) - shortest + 1)):
        return False
    return plain_cover(have, want, shortest) >= part * len(want)
