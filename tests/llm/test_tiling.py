"""Greedy string tiling against a plain version over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import tiling
from tests_llm_plain import documents, plain_cover  # noqa: F401
from tests_llm_plain import plain_tokens as tokens

ITEM_DDL = "item_id long, text string"


def some_tables(seed):
    rng = random.Random(seed)
    words = ["Ab", "bé", "cc", "d'd", "e", "f", "ÉG", "h-h", "i", "j", "kk", "l"]
    items = [" ".join(rng.choices(words, k=rng.randrange(3, 30))) for _ in range(12)] + ["a phrase in all items here " * 2]
    items = [x + " one common ending of them all" for x in items[:6]] + items[6:] + [items[0], None, "", "x y"]
    docs = []
    for _ in range(50):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            item = (rng.choice(items) or "q").split()
            cut = rng.randrange(len(item) + 1) if item else 0
            parts += rng.choice([item, item[cut:] + item[:cut], item[:cut], rng.choices(words, k=8)])
        docs.append(" ".join(parts).upper() if rng.random() < 0.3 else " ,".join(parts))
    return docs + docs[:4] + [None, "", "one common ending of them all " * 200, "w " * 30_000], items


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_equal_the_plain_version(spark, documents, seed):
    texts, items = some_tables(seed)
    docs = documents(texts)
    benchmark = spark.createDataFrame(list(enumerate(items)), ITEM_DDL)
    expected = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            have, want = tokens(text), tokens(item)
            if have and len(want) >= 5 and len(have) < 1500:
                n = plain_cover(have, want, 5)
                if n >= 0.6 * len(want):
                    expected.add((d, i, n))
    long = {d for d, t in enumerate(texts) if len(tokens(t)) >= 1500}
    found = (tiling.leaks(docs, benchmark).join(docs.select("doc_id", *tiling._keys()), ["k1", "k2"])
             .join(benchmark.select("item_id", F.xxhash64("text").alias("item")), "item"))
    rows = {(r.doc_id, r.item_id, r.covered) for r in found.collect() if r.doc_id not in long}
    assert len(expected) > 20
    # Ties between equally long matches may be broken either way; what is found must agree, and nearly all counts.
    assert {r[:2] for r in rows} ^ {r[:2] for r in expected} == set()
    assert len(rows ^ expected) <= 0.1 * len(expected)


def test_reordered_passage_is_found_and_a_clean_text_is_not(spark, documents):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a rather strong potion today"
    w = item.split()
    docs = documents([f"intro {' '.join(w[10:])} middle words {' '.join(w[:10])} end",
                      "nothing of that is in here and it stays as it was", None, "x " + item.upper() + "!!", "early " + " ".join(w[:8])],
                     [10, 11, None, 10, 14]).withColumn("k1", F.lit(1))
    benchmark = spark.createDataFrame([(1, item)], ITEM_DDL)
    left = tiling.remove_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id) for r in left.collect())) == ["11", "14", "None"]


def test_seeds_do_not_depend_on_chunks(monkeypatch):
    text = tiling.token_bytes(("Äb c_d e-f 12 " * 50).encode())
    whole = tiling.seeds(text)
    monkeypatch.setattr(tiling, "CHUNK", 7)
    assert np.array_equal(whole, tiling.seeds(text))
    assert len(whole) == len(text.split()) - 4
    assert len(set(whole.tolist())) == 6


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three four five six")], ITEM_DDL)
    docs = documents(["one two three four five six"])
    assert tiling.remove_leaks(docs.filter("doc_id < 0"), benchmark).collect() == []
    assert tiling.remove_leaks(docs, benchmark.filter("item_id < 0")).count() == 1
