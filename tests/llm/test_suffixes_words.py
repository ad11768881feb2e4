"""The pipeline's windows, 50 words or else 400 bytes, against a plain version that looks at every window."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from accountlens.llm import suffixes
from tests_llm_plain import documents  # noqa: F401

WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")


def plain(texts, words, window):
    raws = [(t or "").encode() for t in texts]
    places = [[m.span() for m in WORD.finditer(r)] for r in raws]
    tokens = [r.split() for r in raws]
    by_words = Counter(tuple(w[i:i + words]) for w in tokens for i in range(len(w) - words + 1))

    def sparse(part):
        return sum(1 for m in WORD.finditer(part) if m.start() and m.end() < window) < words

    by_bytes = Counter(r[i:i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r, place, w in zip(raws, places, tokens, strict=True):
        gone = bytearray(len(r))
        for i in range(len(w) - words + 1):
            if by_words[tuple(w[i:i + words])] > 1:
                a, b = place[i][0], place[i + words - 1][1]
                gone[a:b] = b"\x01" * (b - a)
        for i in range(len(r) - window + 1):
            if by_bytes[r[i:i + window]] > 1 and sparse(r[i:i + window]):
                gone[i:i + window] = b"\x01" * window
        out.append(bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def some_texts(rng, words, window):
    """Passages of short and of long words, between other words and other white space, and one word over and over."""
    def passage(n, size):
        return [("".join(rng.choices("abcdefé", k=rng.randrange(1, size)))) for _ in range(n)]

    blocks = [passage(words + k, s) for k in (-1, 0, 1, 15) for s in (3, 6, 3 * window // words)]
    texts = []
    for _ in range(40):
        w = []
        for _ in range(rng.randrange(1, 4)):
            w += rng.choice(blocks) + passage(rng.randrange(1, words), 8)
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    return texts + texts[:2] + [None, "", " ", "de " * (words + 1), "z" * (3 * window), "漢" * window, "é " * words]


@pytest.mark.parametrize(("words", "window", "gram", "word_gram", "unit", "seed"),
                         [(8, 64, 8, 3, 4096, 1), (8, 64, 8, 3, 2, 2), (50, 400, 40, 5, 4096, 3)])
def test_equal_to_the_plain_version(documents, words, window, gram, word_gram, unit, seed):
    texts = some_texts(random.Random(seed), words, window)
    found = suffixes.cleaned(documents(texts), window, gram, unit, words, word_gram)
    rows = suffixes.keyed(documents(texts), "doc_id").join(found, ["k1", "k2"]).select("doc_id", "kept").collect()
    assert sorted(map(tuple, rows)) == list(enumerate(plain(texts, words, window)))


def test_short_words_are_a_passage(documents):
    """Fifty-five words in some 300 bytes, in two texts."""
    rng = random.Random(6)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(55))
    assert len(passage) < 400
    docs = documents(["one " + passage + " two", "three\n" + passage.replace(" ", "  ") + " four", "no " * 3])
    assert {r.text for r in suffixes.remove_repeats(docs).collect()} == {"one  two", "three\n four", "no " * 3}
