"""Importance resampling towards a target: documents whose words look like the benchmark's are drawn more often.

Features are runs of one to three words, hashed to ``BUCKETS`` buckets by the crc32 of their bytes. Buckets are counted over all
documents and over all target texts; the log ratio of the two is a bucket's gain, a document's weight the sum of its features'
gains, and noise by the hash of its id (Gumbel) turns the highest scores into a draw without replacement.

No run of words is ever spelt out. Each Python worker keeps a dictionary of the distinct words that it has met, as an
Aho-Corasick automaton: a word with a delimiter at both ends, carrying its crc32 and its length. A scan of a batch of
texts emits these payloads word by word. The crc of a run follows from those of neighbouring payloads: crc(ab) is crc(a), moved
on by the length of b, xor crc(b), and moving on is a linear map, read from tables. Words that are not in the dictionary are hashed on
their own; those that repeat join it when there are enough of them. It holds at most ``WORDS`` words of at most ``LONGEST`` bytes
and starts anew when it is full, so memory is bounded and results do not depend on it.

The texts are read twice, to count and to score; a task sends ``BUCKETS`` counts, and the gains (one row a bucket) are broadcast.
The draw is a global rank over a range-partitioned table of scores.

Defined cases: null and empty texts, and texts without words, have no features and weight 0; a document with a null id is
counted and weighed but has no score and is never drawn; ties go to the smaller id, then to the smaller number
of features, and rows alike in all that are drawn in any order; no documents give no rows, and an empty target gives gains
all the same (T is 0).
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accountlens.llm.common import as_bytes, in_slices, map_texts, read_table, written

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Most words of a worker's dictionary, and the longest of them in bytes.
WORDS = 60_000
LONGEST = 40
#: New words are learnt when those that a batch repeats make up this share of it.
WORTH = 0.03
#: Bytes of text that are scanned at a time.
SLICE = 1_000_000

#: A-Z become a-z, the other bytes below 0x80 that are neither digits nor letters become the delimiter.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_STEP = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)


def _moved_one(crc: np.ndarray) -> np.ndarray:
    """What a crc adds to that of a text with one more byte."""
    return (crc >> np.uint32(8)) ^ _STEP[crc & np.uint32(255)]


def _tables(count: int) -> np.ndarray:
    """[n, k, b]: what byte k of a crc, being b, adds to the crc of a text that has n more bytes."""
    byte = np.arange(256, dtype=np.uint32)
    now = np.stack([byte << np.uint32(8 * k) for k in range(4)])
    out = np.empty((count, 4, 256), np.uint32)
    for n in range(count):
        out[n] = now
        now = _moved_one(now)
    return out


_NEAR = _tables(64)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """What each crc adds to that of a text with so many more bytes."""
    out = crc.copy()
    near = by < len(_NEAR)
    c, n = crc[near], by[near]
    out[near] = _NEAR[n, 0, c & 255] ^ _NEAR[n, 1, c >> 8 & 255] ^ _NEAR[n, 2, c >> 16 & 255] ^ _NEAR[n, 3, c >> 24]
    far = np.flatnonzero(~near)
    if len(far):
        # One map for each power of two, the square of the one before.
        table, rest, c = _NEAR[1], by[far].copy(), crc[far]
        while rest.any():
            odd = (rest & 1).astype(bool)
            c[odd] = _apply(table, c[odd])
            table, rest = _apply(table, table), rest >> 1
        out[far] = c
    return out


class Dictionary:
    """Words met so far, as an automaton that emits their number, and their crc and length by that number."""

    def __init__(self, most: int = WORDS, worth: float = WORTH):
        self.most, self.worth = most, worth
        self.forget()

    def forget(self) -> None:
        self.words: list[bytes] = []
        self.crcs, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.automaton: ahocorasick.Automaton | None = None

    def _learn(self, words: list[bytes]) -> None:
        if len(self.words) + len(words) > self.most:
            self.forget()
        self.words += words[:self.most]
        self.crcs = np.array([zlib.crc32(w) for w in self.words], np.uint32)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.automaton = ahocorasick.Automaton()
        for number, word in enumerate(self.words):
            # One character for each byte, so that places are places of bytes.
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()

    def scan(self, joined: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The crc and length of each word of a text that starts and ends with a delimiter and has one between words."""
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        count = len(gaps) - 1
        if count < 1:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.diff(gaps) - 1
        crcs = np.zeros(count, np.uint32)
        unknown = np.ones(count, bool)
        if self.automaton is not None:
            pairs = itertools.chain.from_iterable(self.automaton.iter(joined.decode("latin-1")))
            emitted = np.fromiter(pairs, np.int64).reshape(-1, 2)
            # A payload comes with the place of the delimiter behind its word.
            word = np.searchsorted(gaps, emitted[:, 0]) - 1
            crcs[word] = self.crcs[emitted[:, 1]]
            lengths[word] = self.lengths[emitted[:, 1]]
            unknown[word] = False
        at = np.flatnonzero(unknown)
        others = [joined[a:b] for a, b in zip((gaps[at] + 1).tolist(), gaps[at + 1].tolist(), strict=True)]
        crcs[at] = np.fromiter(map(zlib.crc32, others), np.uint32, len(others))
        if len(others) > self.worth * count:
            again = {w: n for w, n in Counter(others).items() if n > 1 and len(w) <= LONGEST}
            if sum(again.values()) > self.worth * count:
                self._learn(list(again))
        return crcs, lengths


def plain_words(text: bytes) -> bytes:
    """The words of a text in lower case, one delimiter between them."""
    return b" ".join(text.translate(_PLAIN).split())


def feature_buckets(texts: list[bytes], words: Dictionary, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket and the text of each feature, and the number of words of each text."""
    parts = [plain_words(t) for t in texts]
    counts = np.array([p.count(b" ") + 1 if p else 0 for p in parts], np.int64)
    crcs, lengths = words.scan(b" ".join([b"", *(p for p in parts if p), b""]))
    text = np.repeat(np.arange(len(texts)), counts)
    # A later word is taken with the delimiter before it: crc(" " + word).
    space = np.full(len(crcs), zlib.crc32(b" "), np.uint32)
    spaced, longer = moved(space, lengths) ^ crcs, lengths + 1
    found, of, run = [crcs], [text], crcs
    for n in range(1, RUN):
        run = moved(run[:-1], longer[n:]) ^ spaced[n:] if len(run) else run
        inside = text[:len(run)] == text[n:] if len(run) else np.zeros(0, bool)
        found.append(run[inside])
        of.append(text[n:][inside])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(of), counts


_WORKER: list[Dictionary] = []


def _dictionary() -> Dictionary:
    """The worker's dictionary, kept from task to task."""
    if not _WORKER:
        _WORKER.append(Dictionary())
    return _WORKER[0]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts of the column ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in in_slices(batches, limit=SLICE):
            found, _, _ = feature_buckets(batch.column(0).to_pylist(), _dictionary(), buckets)
            total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    return texts.select(as_bytes().alias("body")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket."""
    have = bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    want = bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    counts = have.unionByName(want).unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    total = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))

    def real(c: Column) -> Column:
        return c.cast("double")

    ratio = (real(F.col("t") + 1) * real(F.col("all_s") + buckets)) / (real(F.col("s") + 1) * real(F.col("all_t") + buckets))
    return counts.join(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weighed(docs: DataFrame, gains: DataFrame, carry: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``carry`` columns, n_words, n_features and weight of each document. ``gains`` has one row a bucket."""
    rows = gains.toArrow()
    table = np.zeros(buckets, np.int64)
    table[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    known = docs.sparkSession.sparkContext.broadcast(table)

    def work(texts: list[bytes]) -> tuple:
        n_words, n_features, weight = [], [], []
        begin = 0
        while begin < len(texts):
            stop, size = begin, 0
            while stop < len(texts) and (stop == begin or size + len(texts[stop]) < SLICE):
                size += len(texts[stop])
                stop += 1
            found, of, counts = feature_buckets(texts[begin:stop], _dictionary(), buckets)
            n = stop - begin
            weight.append(np.rint(np.bincount(of, known.value[found], n)).astype(np.int64))
            n_features.append(np.bincount(of, minlength=n).astype(np.int64))
            n_words.append(counts)
            begin = stop
        none = [np.zeros(0, np.int64)]
        return tuple(np.concatenate(x or none) for x in (n_words, n_features, weight))

    return map_texts(docs, carry, work, "n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hash of the id; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], most: int, name: str) -> DataFrame:
    """``rows`` with a column ``rank``: 1 to ``most`` in this order, null behind."""
    ranges = written(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)
    # One row for each range.
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    place = (F.col("__before") + F.col("__inside")).cast("long")
    return ranges.withColumn("__inside", inside).join(F.broadcast(offsets), "__range").select(
        *rows.columns, F.when(place <= most, place).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    gains = written(bucket_gains(docs, target, buckets), "resample-gains")
    scores = written(weighed(docs, gains, ["doc_id"], buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "resample-scores")
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    most = scores.filter(may).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked(scores.filter(may).select(*columns), [F.desc("score"), F.asc("doc_id"), F.asc("n_features")], most, "resample-ranges")
    others = scores.filter(~may).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(others)


def drawn_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that are drawn, with their columns."""
    chosen = resample(docs, target, percent).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__doc")).distinct()
    return docs.join(chosen, F.col("doc_id") == F.col("__doc"), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: The same rule in DuckDB, with the crc bit by bit for a table of bytes, and byte by byte for each distinct feature.
STATEMENT = r"""
WITH steps AS (
    SELECT list(c ORDER BY b) AS step FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))),
texts AS (
    SELECT 1 AS side, doc_id AS id, text, row_number() OVER () AS r FROM documents
    UNION ALL SELECT 2, item_id, text, -row_number() OVER () FROM benchmark),
words AS (
    SELECT side, id, r, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts),
places AS (SELECT side, r, w, unnest(range(1, len(w) + 1)) AS i FROM words),
runs AS (
    SELECT side, r, array_to_string(w[i:i + n - 1], ' ') AS feature
    FROM places, (SELECT unnest([1, 2, 3]) AS n) WHERE i + n - 1 <= len(w)),
bytes AS (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM runs)),
hashed AS (
    SELECT feature, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda k:
            16 * (strpos('0123456789ABCDEF', substr(x, k, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, k + 1, 1)) - 1)),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, steps),
counted AS (
    SELECT bucket, count(*) FILTER (side = 1) AS s, count(*) FILTER (side = 2) AS t
    FROM runs JOIN hashed USING (feature) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted),
weights AS (
    SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM runs JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 1 GROUP BY r),
scores AS (
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (r) WHERE side = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) FILTER (n_words >= 20) OVER () AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank
FROM ranked
"""
