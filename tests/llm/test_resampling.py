"""Importance resampling against a plain version, and the automaton's payloads against crc32."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from accountlens.llm import resampling
from tests_llm_plain import documents  # noqa: F401

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOME = ["a", "B", "é", "É", " ", "-", "the ", "漢字", "x1", "_", "\n", "  ", "q" * 70, "w" * 200, "9", "\x00", "."]


def words(text):
    return WORD.findall((text or "").encode().lower())


def features(text):
    w = words(text)
    return [zlib.crc32(b" ".join(w[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    n_s, n_t = s.total(), t.total()
    out = []
    for i, text in rows:
        f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words(text))])
    may = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(may[:5 * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(SOME, k=rng.randrange(120))) for _ in range(n)]


def test_buckets_of_random_texts():
    rng = random.Random(1)
    small = resampling.Dictionary(30, 0.0)
    for seed in range(60):
        some = [t.encode() for t in texts(rng.randrange(5), seed)]
        found, of, counts = resampling.feature_buckets(some, small)
        assert len(found) == sum(len(features(t.decode())) for t in some)
        for i, t in enumerate(some):
            assert sorted(found[of == i].tolist()) == sorted(features(t.decode()))
            assert counts[i] == len(words(t.decode()))
    assert small.words


def test_crcs_move_any_distance():
    rng = np.random.default_rng(1)
    for n in [*range(70), 100, 4097, 70_001]:
        tail = rng.bytes(n)
        crc = np.array([zlib.crc32(b"head")], np.uint32)
        assert int(resampling.moved(crc, np.array([n]))[0]) ^ zlib.crc32(tail) == zlib.crc32(b"head" + tail)


def test_equals_plain(spark, documents):  # noqa: F811
    some = [*texts(150, 2), None, "", "same words " * 30, "same words " * 30, "a b c"]
    ids = [*range(152), 500, 500, None]
    target = ["the a the x1 words", "same words", None]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    docs = documents(some, ids)
    found = sorted((tuple(r) for r in resampling.resample(docs, benchmark).collect()), key=str)
    expected = plain(list(zip(ids, some, strict=True)), target)
    assert found == expected
    assert sum(r[4] is not None for r in found) > 2
    drawn = resampling.drawn_documents(docs.withColumn("rank", F.lit(1)), benchmark)
    assert drawn.columns == [*docs.columns, "rank"]
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in found if r[4] is not None}


def test_empty_tables(spark, documents):  # noqa: F811
    docs = documents(["some words here"] * 3)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.weight for r in resampling.resample(docs, none).collect()} == {r[2] for r in plain([(i, "some words here") for i in range(3)], [])}
    assert resampling.resample(docs.filter("doc_id < 0"), none).collect() == []


def test_ranks_over_ranges(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score"))
    out = resampling.ranked(rows, [F.desc("score"), F.asc("doc_id")], 300, "test-ranks").collect()
    order = sorted(out, key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in order] == [*range(1, 301)] + [None] * 700
