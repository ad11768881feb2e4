"""Alignment of two tokenisations against a plain version with the libraries that the files are made for."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import alignment
from tests_llm_plain import documents  # noqa: F401

spm = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

SOME = (list("abcdefgh   \n\t\r.,!?;:#%&*()'\"-_0123456789éñß▁😀漢字кА\x00\x0b\x85\xa0‍")
        + ["  ", "the ", " of", "ing", " Alignment", "https://", "\r\n", "<s>", "</s>", "<0x41>", "<|endoftext|>", "don't", " 2024"])


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(public.path("byte_bpe_50k.json")) as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return a, {i: alignment.byte_level(e) for e, i in vocabulary.items() if e != "<|endoftext|>"}, spm.SentencePieceProcessor(
        model_file=public.path("piece_bpe_32k.model"))


def some_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(SOME, k=rng.randrange(70))) for _ in range(n)]


LONG = ["a" * 3000, "x " * 2000, " " * 3000, "é" * 2000, "漢字" * 1000, "\n" * 999, "!" * 2000, "ab-" * 1500, "😀" * 500]


def plain(texts, libraries):
    a, a_bytes, b = libraries
    rows = []
    for t in texts:
        whole = b" " + (t or "").encode()
        x = a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        pieces = [b.id_to_piece(i) for i in y]
        y_bytes = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
        if not t or b"".join(a_bytes[i] for i in x) != whole or b"".join(y_bytes) != whole:
            rows.append(([], [], []))
            continue
        ends = []
        for sizes in ([len(a_bytes[i]) for i in x], [len(s) for s in y_bytes]):
            at, out = 0, []
            for s in sizes:
                at += s
                out.append(at)
            ends.append(out)
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append((x[i:k], y[j:m]))
            i, j = k, m
        rows.append((x, y, groups))
    links = [Counter(p for left, right in g for p in ((u, v) for u in left for v in right)) for _, _, g in rows]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (u, _), n in held.items():
        best[u] = max(best[u], n)
    out = []
    for i, ((x, y, groups), c) in enumerate(zip(rows, links, strict=True)):
        text = ";".join(f"{','.join(map(str, u))}|{','.join(map(str, v))}" for u, v in groups)
        out.append((i, len(x), len(y), len(groups), sum(c.values()), sum(n for p, n in c.items() if held[p] == best[p[0]]),
                    sum(n * held[p] for p, n in c.items()), hashlib.sha256(text.encode()).hexdigest() if x else ""))
    return out


@pytest.mark.parametrize("near", [alignment.NEAR, 40, 0])
def test_report_equals_plain(documents, libraries, near):  # noqa: F811
    texts = [*some_texts(120), *LONG, None, "", "same text", "same text", "\x00"]
    found = alignment.alignment_report(documents(texts), alignment.default_files(), near).collect()
    assert sorted(tuple(r) for r in found) == plain(texts, libraries)


def test_forgetting_changes_nothing(libraries):
    small = alignment.Aligner(alignment.default_files(), keep=100)
    texts = some_texts(200, 5)
    digests = []
    for i in range(0, len(texts), 7):
        digests += small.align_texts([t.encode() for t in texts[i:i + 7]]).digests
    assert digests == [r[-1] for r in plain(texts, libraries)]
    assert small.held < 100 + 7 * 200


def test_long_groups_are_counted():
    own = alignment.Aligner(alignment.default_files())
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 30, 100), rng.integers(0, 30, 101)
    # Only the last ends are shared.
    own.tokenisers.a_size, own.tokenisers.b_size = np.full(30, 101), np.full(30, 100)
    own._learn(a, b, np.array([100]), np.array([101]))
    links = Counter((x, y) for x in a.tolist() for y in b.tolist())
    assert own.totals.tolist() == [10100] and own.groups.tolist() == [1]
    assert {divmod(c, own.wide): n for c, n in zip(own.codes.tolist(), own.links.tolist(), strict=True)} == dict(links)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT NULL, 'fine'")
    rows = {r.doc_id: r for r in alignment.alignment_report(docs.withColumn("row", F.lit(1)), alignment.default_files()).collect()}
    assert tuple(rows[1])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert rows[None].n_a > 0


def test_empty_table(documents):  # noqa: F811
    docs = documents(["x"]).filter("doc_id < 0")
    assert alignment.alignment_report(docs, alignment.default_files()).collect() == []
