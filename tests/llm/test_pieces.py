"""Encoding and decoding against the library, on texts made to be difficult."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from accountlens.llm import pieces
from tests_llm_plain import documents  # noqa: F401

spm = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")

ALPHABET = (list("abcdefgh   \n\t\r.,!?;:#%&$*()[]{}'\"-_=+/\\<>|@~^`0123456789éñüß▁😀漢字کАbВ‍\x00\x01ﬁ ")
            + ["  ", "the ", " of", "ing", "://", "\r\n", "ℵ", "<s>", "</s>", "<0x41>"])


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    return pieces.Encoder(pieces.default_model())


def some_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(n)]


LONG = ["a" * 5000, "ab" * 3000, "x " * 3000, " " * 5000, "é" * 3000, "https://" * 500, "漢字" * 2000, "\n" * 999, "!" * 3000]


def test_ids_and_spans(library, own):
    for text in some_texts(2000) + LONG:
        found = own.encode(text)
        assert [i for i, _, _ in found] == library.encode(text)
        raw, end = text.encode(), 0
        for i, a, b in found:
            assert a == end
            end = b
        assert end == len(raw)
        # A whole piece stands for its own characters.
        for i, a, b in found:
            body = own.surface[i].replace("▁".encode(), b" ")
            assert raw[a:b].replace("▁".encode(), b" ") in (body, body[1:])


def test_decode(library, own):
    rng = random.Random(2)
    for text in some_texts(500):
        ids = [*library.encode(text), own.end]
        assert own.decode(ids) == library.decode(ids)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), 13, 28705, 2, 0]) for _ in range(rng.randrange(1, 9))]
        assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser_with_a_compiled_map(rule, squeeze):
    from sentencepiece import sentencepiece_model_pb2 as proto

    library = spm.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                          remove_extra_whitespaces=squeeze)
    spec = proto.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    own = pieces.Normalizer(spec.normalizer_spec.precompiled_charsmap, True, squeeze, True)
    for text in [*some_texts(300, 3), "ｱﾞ ①ﬃ Å  K ", "  lead", "tail  ", "", "   "]:
        normal, places = own.run(text.encode())
        assert normal == library.normalize(text)
        assert len(places) == len(normal.encode()) + 1
        assert list(places) == sorted(places)
        assert places[-1] <= len(text.encode())


def test_query_columns_equal_the_library(documents, library):  # noqa: F811
    texts = some_texts(100, 4) + LONG + [None, "", "same", "same"]
    rows = pieces.digest_documents(documents(texts), pieces.default_model(), ["doc_id"]).collect()
    expected = []
    for i, t in enumerate(texts):
        ids = [*library.encode(t or ""), 2]
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r)[:4] for r in rows) == expected


def test_documents_with_clashing_columns(documents):  # noqa: F811
    docs = documents(["é b", None]).withColumn("known", F.lit(1))
    rows = sorted(pieces.encode_documents(docs, pieces.default_model(), ["doc_id", "known"]).collect())
    assert [r.decoded for r in rows] == ["é b", ""]
    assert [r.ids[-1] for r in rows] == [2, 2]
    assert rows[0].ends == [2, 4, 4]
    assert rows[0].known == 1


def test_forgetting_changes_nothing(monkeypatch, own):
    texts = [t.encode() for t in some_texts(50, 5)]
    whole = [a for a, _, _ in own.encode_batch(texts)]
    monkeypatch.setattr(pieces, "KEEP", 3)
    own.known.clear()
    assert [a for a, _, _ in own.encode_batch(texts)] == whole
