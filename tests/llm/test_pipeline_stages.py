"""The pipeline's stages: tokens, columns, and odd input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from accountlens.llm import pieces
from tests_llm_plain import documents  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")
spm = pytest.importorskip("sentencepiece")


def test_tokens_of_a_run_are_the_librarys(spark):
    """What the stages before leave of each document is held against brute force in ``test_pipeline_rules``."""
    import public_tokenizers

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    library = spm.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert len(rows) > 50
    for r in rows:
        assert r.ids == [*library.encode(r.text), 2]
        assert len(r.ends) == len(r.ids)
        assert r.ends[-1] == len(r.text.encode())
        assert r.n_chars == len(r.text)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_empty_documents(spark, documents):
    docs = documents(["x"]).filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []


def test_pieces_are_the_models():
    assert pieces.Encoder(pieces.default_model()).end == 2


def test_nulls_and_clashing_columns(spark, documents):
    text = "some words that a reader may find in a text of about this length, and no more of them than that. " * 3
    docs = documents([text, text, None, "", "x" * 100_000, text + " other words"], [1, 1, None, 2, None, 3])
    docs = docs.withColumns({c: F.lit(None).cast("int") for c in ("lang", "source", "n_chars")}).withColumns(
        {c: F.lit(7) for c in ("k1", "kept", "fp", "root", "score", "body", "seed", "n_words", "good", "item")})
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert stage is corpus_pipeline.tokenize or out.columns == docs.columns
        assert out.count() <= docs.count()
        assert stage is not corpus_pipeline.tokenize or out.count() == docs.count()
