"""Katz scores against a plain version, and the sums of its probabilities."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import katz
from accountlens.llm.common import crc_bucket
from tests_llm_plain import documents  # noqa: F401


def plain(texts, trains):
    """Base score, score and counts of each text, by dictionaries."""
    rows = [[*(t or "").encode().lower().split(), "END"] for t in texts]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for r, learn in zip(rows, trains, strict=True):
        if learn:
            words.update(r)
            seq = ["BEGIN", *r]
            pairs.update(zip(seq, seq[1:], strict=False))
            contexts.update(seq[:-1])
    total = sum(words.values())

    def discount(counter):
        n = Counter(counter.values())
        d = {}
        for r in range(1, 6):
            tail = 6 * n[6] / n[1] if n[1] else 1
            x = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0
            d[r] = x if 0 < x < 1 else (r - 0.5) / r
        return lambda c: d.get(c, 1.0) * c

    kept1, kept2 = discount(words), discount(pairs)
    mass = sum(kept1(c) for c in words.values())
    size = total if total - mass > 1e-9 else total + 1
    unknown = 1 - mass / size if total else 1.0

    def p1(w):
        return kept1(words[w]) / size if w in words else unknown

    followers = {}
    for (v, w), c in pairs.items():
        followers.setdefault(v, {})[w] = c

    def p2(v, w):
        if v not in contexts:
            return p1(w)
        kept = sum(kept2(c) for c in followers[v].values())
        divisor = contexts[v] if contexts[v] - kept > 1e-9 else contexts[v] + 1
        if w in followers[v]:
            return kept2(followers[v][w]) / divisor
        return (1 - kept / divisor) / (1 - sum(p1(x) for x in followers[v])) * p1(w)

    out = []
    for r in rows:
        out.append((len(r), sum(w in words for w in r), total,
                    sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in r),
                    sum(math.log10(p2(v, w)) for v, w in zip(["BEGIN", *r], r, strict=False))))
    return out, words, contexts, p2


def some_texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["É", "the"] * 30
    return [" ".join(rng.choices(vocabulary, k=rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize(("hot", "bucket", "block"), [(10**6, 10**6, 10**7), (20, 50, 300)])
def test_equal_to_the_plain_version(monkeypatch, documents, hot, bucket, block):
    monkeypatch.setattr(katz, "HOT", hot)
    monkeypatch.setattr(katz, "BUCKET", bucket)
    monkeypatch.setattr(katz, "BLOCK_BYTES", block)
    texts = some_texts(150) + [None, "", " ", "the THE the", "unseen words only here zzz", "a " * 3000, "dup dup", "dup dup"]
    rest = crc_bucket("doc_id", 10)
    rows = sorted(katz.score_documents(documents(texts), rest != 0, rest == 0).collect())
    trains = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    expected, words, contexts, p2 = plain(texts, trains)
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for r, e, learn in zip(rows, expected, trains, strict=True):
        assert r.held_out == (not learn)
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert r.base_score == pytest.approx(e[3], rel=1e-9)
        assert r.score == pytest.approx(e[4], rel=1e-9)
    for v in [*list(contexts)[:40], "never"]:
        assert sum(p2(v, w) for w in words) + p2(v, "not a word") == pytest.approx(1)


def test_backoff_weights_use_up_what_is_left():
    rng = np.random.default_rng(1)
    sums = rng.integers(0, 5, (katz.CUTOFF + 1, 200))
    sums[0] += 1
    sums[:, 7] = [0, 0, 0, 0, 0, 9]
    d = katz.discounts([900, 300, 120, 60, 40, 30])
    mass = rng.random(200) * 0.9
    weight, divisor = katz.backoff(sums, mass, d)
    low = np.arange(1, katz.CUTOFF + 1)[:, None]
    kept = ((sums[:-1] * low * d[1:, None]).sum(0) + sums[-1]) / divisor
    assert np.allclose(kept + weight * (1 - mass), 1)
    assert (weight > 0).all()
    assert divisor[7] == 10


def test_packing():
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        x = np.sort(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        assert np.array_equal(katz.unpack_sorted(katz.pack_sorted(x)), x)
        assert np.array_equal(katz.unpack(katz.pack(x[::-1])), x[::-1])


def test_nothing_to_learn_from(documents):
    docs = documents(["some words", None], [None, 3]).withColumn("codes", F.lit(1))
    rows = katz.score_documents(docs, F.lit(False), F.lit(False)).collect()
    assert sorted(((r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in rows)) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    assert katz.score_documents(docs.filter("doc_id < 0"), F.lit(True), F.lit(False)).collect() == []
