"""Learnt operators: held-out accuracy on the supplied tables, and the properties that their methods promise."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import classifier, language, ngrams, quality_rules
from tests_llm_plain import documents  # noqa: F401

SF_DIR = "/root/testdata/sf0.01"
supplied = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@supplied
def test_classifier_holds_on_unseen_documents(spark):
    rows = classifier.query(spark, SF_DIR).join(read(spark, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@supplied
def test_language_holds_on_unseen_documents(spark):
    rows = language.query(spark, SF_DIR).join(read(spark, "documents").select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == read(spark, "documents").count()
    held = [r for r in rows if r.held_out and r.lang and r.n_chars > 100]
    assert len(held) > 100
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


@supplied
def test_rules_hold_on_labels(spark):
    rows = quality_rules.query(spark, SF_DIR).join(read(spark, "labels"), "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows if not r.base_failed]) > 0.97


def test_scores_are_the_softmax_of_the_mean_vector():
    """The table of one number a bucket gives what the layer gives on the mean."""
    texts = [b"good text here", b"bad ### ###", "é".encode(), b""]
    model = classifier.fit(texts * 5, np.array([1, 0, 1, 0] * 5))
    for text, score in zip(texts, model.scores(texts), strict=True):
        parts = list(ngrams.buckets(text, classifier.SIZES, classifier.BITS, repeats=True))
        at = np.concatenate(parts) if parts else np.zeros(0, int)
        logit = model.table[at].mean() + model.bias if len(at) else model.bias
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = ("añb  cd cd cd\t" * 30 + "x").encode()
    whole = np.sort(np.concatenate(list(ngrams.buckets(text, (1, 2, 3), 11, repeats=True))))
    plain = " ".join(text.decode().split())
    assert len(whole) == (
        sum(len(w) for w in plain.split())                                              # single characters
        + len(plain) + 1                                                                # pairs
        + sum(1 for i in range(len(plain)) if plain[i] != " ")                          # triples, by their middle
        + len(plain.split())                                                            # words
        + 2 * sum(a == b for a, b in zip(plain.split(), plain.split()[1:], strict=False)))  # marks, by bytes
    monkeypatch.setattr(ngrams, "CHUNK", 7)
    assert np.array_equal(whole, np.sort(np.concatenate(list(ngrams.buckets(text, (1, 2, 3), 11, repeats=True)))))


def test_odd_texts_and_no_labels(spark, documents):
    texts = [None, "", "123 !!", "some words", "w" * 300_000]
    docs = documents(texts, [0, None, 2, 3, 3])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = classifier.learn(docs, labels, F.lit(True))
    assert {r.score for r in classifier.score(docs, model, ["doc_id"]).collect()} == {0.5}
    assert quality_rules.learn(docs, labels) is None
    assert [r.text for r in quality_rules.filter_documents(docs, labels).collect()] == []
    found = language.predict(docs, language.learn(docs, F.lit(True)), ["doc_id", "text"]).collect()
    assert {(r.text or "")[:4]: r.lang_pred for r in found} == {"": "und", "123 ": "und", "some": "en", "wwww": "en"}
    unlearnt = language.learn(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, unlearnt, ["doc_id"]).collect()} == {"und"}


def test_languages_are_separated_within_their_family():
    rng = random.Random(1)
    words = {"en": "the of and thing", "de": "der die und ding", "fr": "le la et chose", "es": "el la y cosa", "xx": "qu qa qi zz"}
    texts, langs = [], []
    for lang, some in words.items():
        for _ in range(40):
            texts.append(" ".join(rng.choices(some.split(), k=20)).encode())
            langs.append(lang)
    model = language.fit(texts, langs)
    assert model.families == ["germanic", "romance", "xx"]
    assert model.pairs == [("de", "en"), ("es", "fr")]
    assert [model.predict(t)[0] for t in texts] == langs
    assert all(0 <= model.predict(t)[1] <= 1 for t in texts)


def plain_statistics(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    marked = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))


def test_statistics_equal_the_plain_version(documents):
    rng = random.Random(3)
    texts = [None, "", " \n", "a " * 200, "x y z\u0085 #"] + [
        "".join(rng.choices(["a ", "b ", "é\n", "c\t", "# ", "dd "], k=rng.randrange(120))) for _ in range(60)]
    rows = quality_rules.judge(documents(texts), None, ["doc_id"]).collect()
    assert sorted(tuple(r)[:6] for r in rows) == [(i, *plain_statistics(t)) for i, t in enumerate(texts)]
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)


def test_trees_are_monotone():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality_rules.FEATURES)))
    y = (x[:, 0] + np.sin(9 * x[:, 2]) + rng.normal(0, 0.5, 600) > 1).astype(float)
    trees = quality_rules.grow_trees(x, y)
    for f, way in enumerate(quality_rules.MONOTONE):
        if way:
            base = x[:80].copy()
            scores = []
            for v in np.linspace(0, 1, 25):
                base[:, f] = v
                scores.append(trees.score(base))
            assert (np.diff(np.array(scores), axis=0) * way >= -1e-12).all()
    assert np.mean((trees.score(x) > 0.5) == y) > 0.6
