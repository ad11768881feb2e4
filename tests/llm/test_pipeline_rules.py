"""The pipeline's documents against brute force for its near-copy rule and its passage rule."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from accountlens.llm import quality_rules
from test_near_copies import plain_kept
from test_suffixes_words import plain
from tests_llm_plain import plain_leak

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")


def test_run_equals_the_plain_rules(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    docs = sorted((r.doc_id, r.text) for r in read("documents").collect())
    trees = quality_rules.learn(read("documents"), read("labels"))
    docs = [(i, t) for i, t in docs if quality_rules.judge_texts([t.encode()], trees)[6][0]]
    kept = plain_kept([t for _, t in docs])
    docs = [docs[k] for k in sorted(kept)]
    texts = dict(zip((i for i, _ in docs), plain([t for _, t in docs], 50, 400), strict=True))
    benchmark = [r.text for r in read("benchmark").collect()]
    texts = {i: t for i, t in texts.items() if not any(plain_leak(t, b, 5, 0.6) for b in benchmark)}
    assert {r.doc_id: r.text for r in corpus_pipeline.run(spark, SF_DIR).collect()} == texts
