"""Repeated windows against a plain version that looks at every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import suffixes
from tests_llm_plain import documents  # noqa: F401


def plain(texts, window):
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i:i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - window + 1):
            if counts[r[i:i + window]] > 1:
                gone[i:i + window] = b"\x01" * window
        left = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def some_texts(rng, n, window):
    letters = "abcdé \n"
    blocks = ["".join(rng.choices(letters, k=rng.randrange(window // 2, 4 * window))) for _ in range(8)]
    texts = ["".join(rng.choice(blocks + ["".join(rng.choices(letters, k=rng.randrange(1, 3 * window)))])
                     for _ in range(rng.randrange(1, 6))) for _ in range(n)]
    return texts + texts[:3] + [None, "", "z" * (5 * window), "zy" * (3 * window), "q" * (window - 1), "q" * window,
                                "r" * (window + 1)]


@pytest.mark.parametrize(("window", "gram", "unit", "seed"), [(30, 6, 4096, 1), (30, 6, 2, 2), (400, 40, 4096, 3)])
def test_equal_to_the_plain_version(documents, window, gram, unit, seed):
    texts = some_texts(random.Random(seed), 40, window)
    docs = documents(texts)
    found = suffixes.cleaned(docs, window, gram, unit)
    rows = suffixes.keyed(docs, "doc_id").join(found, ["k1", "k2"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, rows)) == [(i, *x) for i, x in enumerate(plain(texts, window))]


def test_segments_cover_each_start_once_and_equal_windows_have_equal_anchors(monkeypatch):
    rng = np.random.default_rng(4)
    shared = rng.integers(97, 101, 900).astype(np.uint8).tobytes()
    one, two = b"x" * 700 + shared + b"y" * 10, b"ab" * 123 + shared + b"w" * 500
    whole = [suffixes.segments(t) for t in (one, two)]
    monkeypatch.setattr(suffixes, "CHUNK", 100)
    for t, (at, lo, hi, g) in zip((one, two), whole, strict=True):
        assert np.array_equal(np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi, strict=True)]),
                              np.arange(len(t) - 399))
        for a, b in zip(suffixes.segments(t), (at, lo, hi, g), strict=True):
            assert np.array_equal(a, b)
    anchors = []
    for t, (at, lo, hi, _) in zip((one, two), whole, strict=True):
        begin = t.index(shared)
        anchors.append({p - begin: a - begin for a, b, c in zip(at, lo, hi, strict=True) for p in range(b, c + 1)
                        if begin <= p <= begin + 500})
    assert anchors[0] == anchors[1]


def test_texts_keep_their_rows_and_columns(documents):
    shared = "é" + "".join(random.Random(1).choices("abcdefgh ", k=700))
    docs = documents(["one " + shared + " two", "three" + shared, None, "short"], [1, None, 3, 1]).withColumn("k1", F.lit(7))
    kept = suffixes.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_chars, r.k1) for r in kept.collect()), key=str) == sorted(
        [(1, "one  two", 8, 7), (None, "three", 5, 7), (3, None, None, 7), (1, "short", 5, 7)], key=str)


def test_empty_table(documents):
    assert suffixes.remove_repeats(documents(["x"]).filter("doc_id < 0")).collect() == []


@pytest.mark.parametrize(("size", "goes"), [(399, False), (400, True)])
def test_passages_of_over_fifty_words_go_by_their_bytes(spark, documents, tmp_path, size, goes):
    """The query's border is 400 bytes, however many words these hold."""
    rng = random.Random(size)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(58))[:size]
    assert len(passage.encode()) == size and len(passage.split()) > 50
    texts = [f"<{passage}>", f"one [{passage}] two", "left alone"]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    left = {r.doc_id: (r.n_bytes, r.n_removed, r.text) for r in suffixes.query(spark, str(tmp_path)).collect()}
    assert left == {i: (len(t), size * goes if i < 2 else 0, t.replace(passage, "") if goes else t) for i, t in enumerate(texts)}
