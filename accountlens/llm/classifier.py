"""Quality classifier: supervised subword embeddings.

Every word and every character n-gram of a text is hashed to a learned vector, and so is the mark of a word that repeats
the one before it; a document is the mean of its vectors, and
a softmax layer on the mean gives the classes. Vectors and layer are learnt together by stochastic gradient descent
in numpy on a bounded sample of labelled documents (``MAX_SAMPLE`` rows of at most ``MAX_SAMPLE_CHARS`` characters).
The layer is linear in the mean, so for scoring each bucket's vector is multiplied out to one number per bucket;
only that table (``TABLE`` floats, whatever the data) goes to the executors. One pass scores whole texts.

Defined cases: a null or empty text has no vectors and gets the score of the bias alone; without labels of both classes
every score is the share of good labels (0.5 if there are none); repeated rows and null ids are scored like any other,
but a row with a null id or label is not learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import crc_bucket, map_texts, read_table
from accountlens.llm.ngrams import buckets

BITS = 17
SIZES = (3, 4)
DIMENSIONS = 12
MAX_SAMPLE = 4_000
MAX_SAMPLE_CHARS = 50_000
EPOCHS = 4
RATE = 0.3
SEED = 5
#: Buckets of n-grams, as many of words, and the mark of a repeated word.
TABLE = (2 << BITS) + 1


@dataclass
class Model:
    """``table``: what a bucket adds to the log-odds of class 1, times the number of features; ``bias``: the layer's bias."""

    table: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total, n = 0.0, 0
            for part in buckets(text, SIZES, BITS, repeats=True):
                total += float(self.table[part].sum(dtype=np.float64))
                n += len(part)
            out[i] = total / max(n, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def fit(texts: list[bytes], classes: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Vectors and softmax layer of two classes by stochastic gradient descent, one document a step."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (TABLE, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    bags = []
    for text in texts:
        parts = list(buckets(text, SIZES, BITS, repeats=True))
        at, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        bags.append((at.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)))
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            at, share = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ vectors[at] if len(at) else np.zeros(DIMENSIONS)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            error = -p / p.sum()
            error[int(classes[i])] += 1
            back = layer @ error
            layer += step * np.outer(mean, error)
            bias += step * 0.1 * error
            if len(at):
                # A mean of many vectors hardly moves with each of them; the step is scaled so that the mean itself moves by it.
                vectors[at] += np.outer(share * (step / float(share @ share)), back).astype(np.float32)
    gap = layer[:, 1] - layer[:, 0]
    return Model((vectors @ gap).astype(np.float32), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, max_sample: int = MAX_SAMPLE) -> Model:
    """A model from the first ``max_sample`` labelled documents in the order of the hash of their id."""
    sample = (labels.filter(may_learn & F.col("quality").isNotNull()).groupBy("doc_id")
              .agg(F.max("quality").cast("int").alias("quality")))
    known = docs.filter(may_learn).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Ids and lengths are settled before any text moves.
    chosen = (known.filter(F.length("text") <= MAX_SAMPLE_CHARS).select("doc_id").join(sample, "doc_id")
              .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))
    rows = (known.filter(F.length("text") <= MAX_SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect())
    rows.sort(key=lambda r: r.doc_id)
    classes = np.array([r.quality > 0 for r in rows], int)
    if len(set(classes.tolist())) < 2:
        share = float(np.clip(classes.mean() if len(classes) else 0.5, 0.001, 0.999))
        return Model(np.zeros(TABLE, np.float32), float(np.log(share / (1 - share))))
    return fit([r.text.encode() for r in rows], classes)


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns and the score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, carry, lambda texts: [shared.value.scores(texts)], "score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's remainder is not 1, and scores all."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"), crc_bucket("doc_id", 3) != 1)
    return score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
