"""Quality rules: gradient-boosted trees over document statistics, with monotone features.

One pass over the texts gives the statistics. The trees are grown in numpy on the statistics of a bounded sample of
labelled documents (``MAX_SAMPLE`` rows, an explicit parameter; an id counts once) and flattened into node arrays; scoring walks all
rows of a batch through one level of a tree at a time. Nothing but the node arrays leaves the driver.

Monotone features (more of it never raises the score): symbols, repeated lines, repeated words, exclamation marks,
capitals. The constraint holds because every split keeps the means of its sides in order and passes the middle of
the two on as a bound to the subtrees.

Defined cases: a null or empty text has no words, so all statistics are 0, ``base_failed`` is true and it is
rejected. Without usable labels (none, or of one class) no trees are grown and the base rules alone decide. Rows keep
their number: repeated rows and null ids are scored like any other. Columns beyond the inputs are ignored by the
statistics and kept by ``filter_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import SPACES, filter_texts, map_texts, read_table

#: Largest number of labelled documents that the trees are grown on.
MAX_SAMPLE = 20_000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
#: A document goes when the trees give its being good less than this.
MIN_SCORE = 0.5

SYMBOLS = b"#*$%&|<>"

FEATURES = ["log_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "bang_rate",
            "digit_rate", "end_mark_rate", "distinct_rate", "words_per_line", "long_word_rate"]
#: -1: the score never rises with the feature.
MONOTONE = np.array([0, 0, -1, -1, -1, -1, -1, 0, 0, 0, 0, 0])

VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, quality_score double")


def repeat_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    # Ranks of runs of 1, 2, 4, ... words; two overlapping runs make one of any length between.
    length = 1
    while length < window:
        step = min(length, window - length)
        pairs = codes[:-step] * (int(codes.max()) + 1) + codes[step:]
        _, codes = np.unique(pairs, return_inverse=True)
        length += step
    again = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[window:] -= again
    return int(np.count_nonzero(np.cumsum(edge)[:-1] > 0))


def statistics(text: bytes) -> tuple[tuple[int, ...], list[float]]:
    """The five counted statistics and the features of one text."""
    words = text.split()
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    starts = raw[(raw & 0xC0) != 0x80]
    counts = np.bincount(starts, minlength=256)
    chars = len(starts)
    word_chars = chars - int(counts[list(SPACES)].sum())
    symbols = int(counts[list(SYMBOLS)].sum())
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    distinct_lines = len(set(lines))
    repeated = repeat_words(words)
    ended = sum(x.rstrip(SPACES)[-1:] in b".!?:;\"" for x in lines)
    many, rows, letters = max(n, 1), max(len(lines), 1), max(word_chars, 1)
    features = [
        float(np.log1p(n)), word_chars / many, symbols / letters, (len(lines) - distinct_lines) / rows, repeated / many,
        int(counts[65:91].sum()) / letters, int(counts[33]) / many, int(counts[48:58].sum()) / letters, ended / rows,
        len(set(words)) / many, n / rows, sum(len(w) > 20 for w in words) / many]
    return (n, word_chars, symbols, len(lines) - distinct_lines, repeated), features


@dataclass
class Trees:
    """Flattened trees: for node i a feature (-1: leaf), a threshold, two children and a value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document for each row of features."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                inner = f >= 0
                go_left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def grow_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64,
               ridge: float = 1.0, min_leaf: int = 10, monotone: np.ndarray = MONOTONE) -> Trees:
    """Newton boosting of the logistic loss on binned features."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    nodes: list[list] = []
    roots = []
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    total = np.full(len(y), start)

    def weight(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(g / (h + ridge), low, high))

    def gain_of(g, h, low, high):
        w = np.clip(g / (h + ridge), low, high)
        return w, g * w - 0.5 * (h + ridge) * w * w

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(nodes)
        gs, hs = float(g[rows].sum()), float(h[rows].sum())
        own = weight(gs, hs, low, high)
        nodes.append([-1, 0.0, at, at, rate * own])
        step[rows] = rate * own
        if level == depth or len(rows) < 2 * min_leaf:
            return at
        best = (1e-6, -1, -1, 0.0, 0.0)
        whole = gs * own - 0.5 * (hs + ridge) * own * own
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
            wl, a = gain_of(gl, hl, low, high)
            wr, c = gain_of(gs - gl, hs - hl, low, high)
            fits = (nl >= min_leaf) & (len(rows) - nl >= min_leaf) & ((wr - wl) * monotone[f] >= 0)
            gain = np.where(fits, a + c - whole, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float(wl[k]), float(wr[k]))
        _, f, k, wl, wr = best
        if f < 0:
            return at
        goes = binned[rows, f] <= k
        middle = (wl + wr) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        (ll, lh), (rl, rh) = bounds[int(monotone[f])]
        left = grow(rows[goes], g, h, level + 1, ll, lh)
        right = grow(rows[~goes], g, h, level + 1, rl, rh)
        nodes[at] = [f, float(cuts[f][k]), left, right, 0.0]
        return at

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        step = np.zeros(len(y))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -4.0, 4.0))
        total += step
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(feature, threshold, left, right, value, np.array(roots), depth, start)


def learn(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Trees | None:
    """Trees from a bounded sample of labelled documents: the first ``max_sample`` ids in the order of their hash."""
    sample = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
              .groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))
    # An id with several texts counts once, by the text whose hash is least: the rows stay within ``max_sample``.
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    known = (known.groupBy("doc_id", "good").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
             .select("good", "one.text"))
    rows = map_texts(known, ["good"], lambda texts: [[statistics(t)[1] for t in texts]],
                     "features array<double>").collect()
    if len({r.good for r in rows}) < 2:
        return None
    # Sums of floats depend on the order of rows, which Spark doesn't fix.
    rows.sort(key=lambda r: (r.features, r.good))
    return grow_trees(np.array([r.features for r in rows]), np.array([r.good for r in rows], float))


def judge_texts(texts: list[bytes], trees: Trees | None, min_words: int = MIN_WORDS,
                max_repeat_percent: int = MAX_REPEAT_PERCENT, min_score: float = MIN_SCORE) -> list[np.ndarray]:
    """The five statistics, whether the base rules failed, whether the text is kept, and its score."""
    found = [statistics(t) for t in texts]
    stats = np.array([s for s, _ in found], np.int64).reshape(-1, 5).T
    scores = trees.score(np.array([f for _, f in found])) if trees and found else np.ones(len(found))
    failed = (stats[0] < min_words) | (100 * stats[4] > max_repeat_percent * stats[0])
    return [*stats, failed, ~failed & (scores >= min_score), scores]


def judge(docs: DataFrame, trees: Trees | None, carry: list[str]) -> DataFrame:
    """``carry`` columns, the statistics, ``base_failed``, ``kept`` and ``quality_score`` for every row of ``docs``."""
    return map_texts(docs, carry, lambda texts: judge_texts(texts, trees), VERDICT)


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    trees = learn(docs, labels)
    return filter_texts(docs, lambda texts: judge_texts(texts, trees)[6])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, learn(docs, read_table(spark, sf_dir, "labels")), ["doc_id"])
