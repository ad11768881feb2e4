"""SimHash against a plain version: all pairs, union-find."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import simhash
from accountlens.llm.components import components
from tests_llm_plain import documents, plain_groups, plain_print  # noqa: F401


def some_texts(seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta"]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 30, 300]))) for _ in range(120)]
    for t in list(texts[:60]):
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    return texts + texts[:20] + [None, "", " \t\n", "x" * 50_000, "a b " * 20_000, "a b " * 20_000]


def test_fingerprints_and_components_equal_the_plain_version(documents):
    texts = some_texts()
    docs = documents(texts)
    prints = [(i, plain_print(t)) for i, t in enumerate(texts)]
    expected = plain_groups(prints)
    found = simhash.fingerprints(docs, ["doc_id"])
    rows = found.join(simhash.component_table(found), "fp").collect()
    assert {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows} == {(i, p, expected[p]) for i, p in prints}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("unit", [8, 2048])
def test_no_link_is_lost_in_crowded_keys(spark, unit):
    """Many fingerprints a few bits apart: the same components whether keys are dealt out or not."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 64, 4, np.uint64, endpoint=False)
    fps = set()
    for c in centres:
        for _ in range(120):
            fps.add(int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)))))
    fps |= {int(x) for x in rng.integers(0, 1 << 64, 200, np.uint64, endpoint=False)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.find_links(df, unit_size=unit)
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links).collect()}
    for r in links.collect():
        assert ((r.u ^ r.v) % (1 << 64)).bit_count() <= 64
    expected = plain_groups(list(enumerate(fps)))
    groups = {}
    for p in fps:
        groups.setdefault(expected[p], set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_one_document_of_each_group_stays(spark, documents):
    base = "one two three four five six seven eight nine ten eleven twelve"
    docs = documents([base, base, "other words that are not like it at all", base, None, "", base, "null id text alone"],
                     [5, 3, 9, 3, 7, 8, None, None]).withColumn("fp", F.lit("clash"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, base), (9, "other words that are not like it at all"), (7, None), (None, "null id text alone")], key=str)


def test_empty_table(documents):
    docs = documents(["x"]).filter("doc_id < 0")
    assert simhash.keep_one(docs).collect() == []


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(1, 301)}
