"""Language identification by hierarchical discrimination.

A text becomes the shares of its hashed character n-grams and words. A linear model first names the language family,
one support vector machine for each family against the rest. Within the family, languages are separated by one-versus-one
linear support vector machines: each pair votes, and votes are added up, ties by the sum of margins. All machines are
learnt in numpy from a bounded sample of documents with a language (``MAX_SAMPLE`` for each, ``MAX_TOTAL`` in all) and
are one matrix of fixed size, sent to the executors. One pass predicts whole texts.

``FAMILIES`` is a parameter; a language that it doesn't name is a family of its own.

Defined cases: ``und`` with score 0 for a null text, one without a letter, or if nothing could be learnt; a single learnt
language is predicted for every text with a letter. Rows with a null id or language are not learnt from, and are predicted.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import crc_bucket, map_texts, read_table
from accountlens.llm.ngrams import buckets

BITS = 11
SIZES = (1, 2, 3)
MAX_SAMPLE = 1_000
#: Most documents in all; with many languages each gives fewer.
MAX_TOTAL = 20_000
MAX_SAMPLE_CHARS = 50_000
UNKNOWN = "und"

#: Languages by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sl", "hr", "sr", "be", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "semitic": ("ar", "he"),
}


def family_of(language: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if language in members), language)


def features(text: bytes) -> np.ndarray:
    """Shares of all buckets, scaled to length one."""
    counts = np.zeros(2 << BITS)
    for part in buckets(text.lower(), SIZES, BITS):
        counts += np.bincount(part, minlength=2 << BITS)
    return np.sqrt(counts / max(counts.sum(), 1))


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def svm(x: np.ndarray, positive: np.ndarray, rng: np.random.Generator, epochs: int = 12, strength: float = 1e-4,
        batch: int = 16) -> tuple[np.ndarray, float]:
    """A linear support vector machine by steps along the hinge loss; both classes weigh the same."""
    sign = np.where(positive, 1.0, -1.0)
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)) * len(x)
    w, b, w_sum, b_sum, t = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i:i + batch]
            t += 1
            rate = 1 / (strength * (t + 1000))
            wrong = rows[sign[rows] * (x[rows] @ w + b) < 1]
            pull = sign[wrong] * weight[wrong] / len(rows)
            w = w * (1 - rate * strength) + rate * 0.1 * (pull @ x[wrong])
            b += 0.01 * rate * strength * 1000 * float(pull.sum())
            w_sum += w
            b_sum += b
    return w_sum / t, b_sum / t


@dataclass
class Model:
    families: list[str]
    members: dict[str, list[str]]
    #: Columns: a machine for each family, then one for each pair of languages of a family.
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    biases: np.ndarray

    def predict(self, text: bytes) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        margins = features(text) @ self.weights + self.biases
        of_family = margins[:len(self.families)]
        chosen = int(of_family.argmax())
        odds = np.exp(np.clip(4 * (of_family - of_family[chosen]), -50, 0))
        score = 1 / odds.sum()
        votes = dict.fromkeys(self.members[self.families[chosen]], 0.0)
        held: dict[str, float] = dict.fromkeys(votes, 1.0)
        for (a, b), margin in zip(self.pairs, margins[len(self.families):], strict=True):
            if a in votes and b in votes:
                # A vote, and the margin far behind it to break ties.
                votes[a if margin >= 0 else b] += 1
                votes[a] += 1e-3 * float(np.tanh(margin))
                votes[b] -= 1e-3 * float(np.tanh(margin))
                sure = float(1 / (1 + np.exp(-np.clip(4 * margin, -50, 50))))
                held[a], held[b] = min(held[a], sure), min(held[b], 1 - sure)
        best = max(sorted(votes), key=votes.__getitem__)
        return best, float(score * held[best])


def fit(texts: list[bytes], languages: list[str], seed: int = 5, families: dict[str, tuple[str, ...]] = FAMILIES) -> Model:
    rng = np.random.default_rng(seed)
    known = sorted(set(languages))
    members: dict[str, list[str]] = {}
    for language in known:
        members.setdefault(family_of(language, families), []).append(language)
    names = sorted(members)
    x = np.array([features(t) for t in texts]).reshape(len(texts), 2 << BITS)
    of = np.array(languages)
    family = np.array([family_of(language, families) for language in languages])
    machines = [svm(x, family == f, rng) if len(names) > 1 else (np.zeros(x.shape[1]), 0.0) for f in names]
    pairs = [p for f in names for p in combinations(members[f], 2)]
    for a, b in pairs:
        rows = (of == a) | (of == b)
        machines.append(svm(x[rows], of[rows] == a, rng))
    weights = np.array([w for w, _ in machines]).reshape(-1, 2 << BITS).T
    return Model(names, members, pairs, weights, np.array([b for _, b in machines]))


def learn(docs: DataFrame, may_learn: Column, max_sample: int = MAX_SAMPLE) -> Model:
    """A model from the first ``max_sample`` documents of each language in the order of the hash of their text."""
    known = docs.filter(may_learn & F.col("lang").isNotNull() & (F.length("text") <= MAX_SAMPLE_CHARS)).select("lang", "text")
    # Only hashes are ranked; the rank is limited in each map task before it is shuffled. Equal texts count once.
    chosen = (known.select("lang", F.xxhash64("text").alias("h")).distinct()
              .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= max_sample)
              .orderBy("r", "lang").limit(MAX_TOTAL).select("lang", "h"))
    rows = (known.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
            .groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text").collect())
    rows.sort()
    rows = [r for r in rows if has_letter(r.text.encode())]
    if not rows:
        return Model([], {}, [], np.zeros((2 << BITS, 0)), np.zeros(0))
    return fit([r.text.encode() for r in rows], [r.lang for r in rows])


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts):
        found = [shared.value.predict(t) for t in texts]
        return [f[0] for f in found], [f[1] for f in found]

    return map_texts(docs, carry, work, "lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's remainder is not 2, and predicts all."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, crc_bucket("doc_id", 4) != 2)
    return predict(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
