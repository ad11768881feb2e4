"""Near copies of the pipeline's stage against brute force over all pairs of five-word shingle sets."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from accountlens.llm import near_copies, simhash
from tests_llm_plain import documents  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def plain_sets(texts):
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        out.append({b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    return out


def plain_kept(texts):
    """The first text of each group that links of 0.8 or more make."""
    sets, root = plain_sets(texts), list(range(len(texts)))

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i in range(len(texts)) if find(i) == i}


def some_texts(seed=4):
    """Copies around the similarity of 0.8, chains of copies, a line that many share, texts of few words."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(words, k=25))
    texts = []
    for size in (6, 12, 40, 200, 600):
        for _ in range(6):
            t = rng.choices(words, k=size)
            texts.append(" ".join(t))
            for _ in range(6):
                t = list(t) if rng.random() < 0.5 else texts[-1].split()
                for _ in range(rng.randrange(1, 2 + size // 40)):
                    t[rng.randrange(len(t))] = rng.choice(words)
                texts.append(" ".join(t))
    texts += [line + " " + " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 6, 7, 30]))) for _ in range(60)]
    texts += [None, "", " \t", "one two", "One\nTWO", "de " * 40, "de " * 300, "a b " * 200]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("sample", "often"), [(8, 3), (1, 2)])
def test_equal_to_all_pairs(documents, monkeypatch, sample, often):
    monkeypatch.setattr(near_copies, "SAMPLE", sample)
    monkeypatch.setattr(near_copies, "OFTEN", often)
    texts = some_texts()
    expected = plain_kept(texts)
    assert 0.2 * len(texts) < len(expected) < 0.8 * len(texts)
    assert {r.doc_id for r in simhash.keep_one(documents(texts)).collect()} == expected


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")
def test_supplied_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    kept = plain_kept([t for _, t in rows])
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == {rows[i][0] for i in kept}


def test_edited_copies_of_one_text_make_few_pairs(spark, documents):
    """Copies that reach 0.8 with the text they were made from, and hardly with each other."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    origin = rng.choices(words, k=300)
    texts = [" ".join(origin)]
    for k in range(150):
        # 5 to 8 edits: 0.76 to 0.85 to the origin; two such copies share about 0.65.
        t = list(origin)
        for at in rng.sample(range(5, 295), rng.randrange(5, 9)):
            t[at] = f"x{k}-{at}"
        texts.append(" ".join(t))
    expected = plain_kept(texts)
    assert 2 < len(expected) < 100
    assert {r.doc_id for r in simhash.keep_one(documents(texts)).collect()} == expected


def test_sketches_never_drop_a_similar_pair():
    rng = random.Random(7)
    for size in (1, 3, 30, 400, 4000):
        for _ in range(20):
            a = {rng.getrandbits(64) for _ in range(size)}
            b = set(rng.sample(sorted(a), rng.randrange(len(a) + 1))) | {rng.getrandbits(64) for _ in range(rng.randrange(size))}
            x, y = (near_copies.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(a ^ b)
