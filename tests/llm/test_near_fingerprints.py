"""The pipeline's stage of near copies goes through fingerprints; what they miss is found beside them."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from accountlens.llm import common, near_copies, simhash
from tests_llm_plain import documents  # noqa: F401


def test_fingerprints_alone_link_copies_with_few_edits(documents, monkeypatch):
    monkeypatch.setattr(near_copies, "beyond", lambda links, texts, sets: links.limit(0))
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(6):
        origin = rng.choices(words, k=500)
        texts.append(" ".join(origin))
        for _ in range(4):
            t = list(origin)
            t[rng.randrange(500)] = rng.choice(words)
            texts.append("  ".join(t))
    assert {r.doc_id for r in simhash.keep_one(documents(texts)).collect()} == {0, 5, 10, 15, 20, 25}


def test_near_fingerprints_of_other_texts_are_no_link(documents, monkeypatch):
    """One fingerprint for all texts: the shingle sets decide."""
    monkeypatch.setattr(simhash, "majority", lambda hashes: 7)
    texts = [f"{w} one text of a few words that no other text here has in it {w}" for w in ("red", "green", "blue")]
    assert {r.doc_id for r in simhash.keep_one(documents(texts)).collect()} == {0, 1, 2}


def test_direct_links_are_within_the_bits(spark):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 1 << 64, 30, np.uint64, endpoint=False)
    fps = sorted({int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, k))) for c in centres for k in (0, 2, 5, 8)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {frozenset((r.u % (1 << 64), r.v % (1 << 64)))
             for r in simhash.find_links(df, simhash.NEAR_BLOCKS, simhash.NEAR_BITS, direct=True).collect()}
    near = {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= simhash.NEAR_BITS}
    assert found <= near
    assert set().union(*found) == set().union(*near)


def test_block_keys_are_not_broadcast(spark):
    """Each fingerprint has 45 keys, which Spark does not count: a table of a few MB became a broadcast of over 1 GB."""
    df = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    for numbers in ((simhash.BLOCKS, simhash.MAX_BITS), (simhash.NEAR_BLOCKS, simhash.NEAR_BITS)):
        plan = simhash.find_links(df, *numbers)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_shingle_keys_are_not_broadcast(documents, monkeypatch):
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return common.written(df, name)

    monkeypatch.setattr(near_copies, "written", kept)
    simhash.keep_one(documents(["one text of some seven words here", "another text of some seven words there"])).collect()
    assert "SortMergeJoin" in plans["near-keys"] and "BroadcastHashJoin" not in plans["near-keys"]
