"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

``simhash`` finds those whose fingerprints are near; ``verified`` decides on the sets. What is left are links between texts of
different groups whose fingerprints differ in more bits, as far as 21 of 64 on check_s. ``beyond`` finds them without loss.

A set of n shingles that is similar enough to another shares with it one of its first ``n - ceil(0.8 n) + 1`` shingles,
in any order that holds for all texts (prefix filter), so texts that meet under none of these keys are never linked,
and no similar pair is missed. The order is by hash, with shingles that a sample of the texts finds often put last:
it decides only how many texts meet. Two bounds drop pairs that cannot reach the similarity: the places of a shared key in
both sets, and the sketches, ``64 * LONGS`` bits in which each shingle flips one: sets that differ in d shingles differ in d
bits at most. The survivors are checked on their texts.

Keys whose texts are of one group by their fingerprints are done. In the others each text is first checked against one other, the one that has the fewest rarer shingles before the key: in
a group of edited copies that is the text they were made from, as edits make shingles that nobody else has. Keys
whose texts are then of one group are done. In the others, texts of different groups are compared by their
sketches inside the join, so only those that are near, or long enough to fill a sketch, come out of it as pairs.

Defined cases: words are lower-cased bytes between white space; fewer than five words make one shingle, and texts
without words, and null, are alike. Equal texts are worked on once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.llm.common import in_slices, written
from accountlens.llm.components import components
from accountlens.llm.suffixes import keyed, one_each

SEED = 42
SHINGLE_WORDS = 5
#: Least similarity of near copies, as a fraction.
SIMILAR = (4, 5)
#: One text of so many is looked at for frequent shingles, those found so often are put last, so many at most.
SAMPLE, OFTEN, MAX_OFTEN = 8, 3, 200_000
#: Whole numbers of 64 bits in a sketch.
LONGS = 16


def shingles(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The hashes of a text's shingles, each once, in order."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    parts = zip(*(words[i:] for i in range(shingle_words)))  # noqa: B905 - the shortest ends it
    return np.unique(np.fromiter((digest(b" ".join(s), SEED) for s in parts), np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes, each in order, reach the similarity."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return (SIMILAR[0] + SIMILAR[1]) * shared >= SIMILAR[0] * (len(a) + len(b))


def _may_be_similar(n: str, at: str, other_n: str, other_at: str) -> Column:
    """Whether sets of these sizes, whose first shared key stands at these places, can reach the similarity."""
    most = F.least(F.col(n) - F.col(at), F.col(other_n) - F.col(other_at))
    return sum(SIMILAR) * most >= SIMILAR[0] * (F.col(n) + F.col(other_n))


def sketch(codes: np.ndarray) -> np.ndarray:
    """The parity of the hashes in each of the bits."""
    odd = np.bincount((codes % np.uint64(64 * LONGS)).astype(np.int64), minlength=64 * LONGS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(k1, k2, body, id) for each distinct text of ``docs``."""
    return written(one_each(keyed(docs)).withColumn("id", F.monotonically_increasing_id()), "near-texts")


def profiles(texts: DataFrame, fingerprint: Callable[[np.ndarray], int]) -> DataFrame:
    """(id, n, fp, s0, s1, ...) of the texts: the size of the set, its fingerprint, and its sketch."""
    names = ["id", "n", "fp", *(f"s{i}" for i in range(LONGS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            if sets:
                bits = np.stack([sketch(s) for s in sets])
                prints = np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.array([len(s) for s in sets], np.int32)), pa.array(prints),
                     *(pa.array(bits[:, i].copy()) for i in range(LONGS))], names=names)

    found = texts.select("id", "body").mapInArrow(run, "id long, n int, fp long, " + ", ".join(f"s{i} long" for i in range(LONGS)))
    return written(found, "near-sets")


def _near(one: str, other: str) -> Column:
    """Whether two sketches, whose columns begin so, leave the similarity possible."""
    differ = sum(F.bit_count(F.col(f"{one}s{i}").bitwiseXOR(F.col(f"{other}s{i}"))) for i in range(LONGS))
    # Sets that differ in d shingles share (n + m - d) / 2 of them.
    top, bottom = SIMILAR
    return (top + bottom) * differ <= (bottom - top) * (F.col(f"{one}n") + F.col(f"{other}n"))


def _prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.toDF(*(c if c in keep else prefix + c for c in df.columns))


def _often(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles in order, and their places in an order by frequency, from 1 on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [shingles(t) for t in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["key"])

    sample = texts.filter(F.pmod("k1", F.lit(SAMPLE)) == 0).select("body").mapInArrow(run, "key long")
    top = (sample.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
           .orderBy(F.desc("n"), "key").limit(MAX_OFTEN).toArrow())
    keys = np.array(top["key"].to_numpy(), np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], len(keys) - order


def _keys(texts: DataFrame) -> DataFrame:
    """(key, id, n, at) for the first shingles of each text: the size of its set and the key's place in it."""
    often = texts.sparkSession.sparkContext.broadcast(_often(texts))

    def first(codes: np.ndarray) -> np.ndarray:
        keys, places = often.value
        n = len(codes)
        if len(keys):
            spot = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
            codes = codes[np.lexsort((codes, np.where(keys[spot] == codes, places[spot], 0)))]
        return codes[:n + (-SIMILAR[0] * n // SIMILAR[1]) + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            if not sets:
                continue
            found = [first(s) for s in sets]
            counts = [len(s) for s in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), counts)),
                 pa.array(np.repeat([len(s) for s in sets], counts).astype(np.int32)),
                 pa.array(np.concatenate([np.arange(c) for c in counts]).astype(np.int32))], names=["key", "id", "n", "at"])

    return texts.select("id", "body").mapInArrow(run, "key long, id long, n int, at int")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (u, v), in either order, whose texts are similar."""
    # Written first, few pairs are known to be few, and only the texts in them are shuffled.
    pairs = written(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "near-pairs")
    held = texts.join(pairs.select(F.col("u").alias("id")).union(pairs.select("v")), "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One text is in many pairs.
        sets: dict[int, np.ndarray] = {}

        def of(key: int, text: bytes) -> np.ndarray:
            if key not in sets:
                if sum(map(len, sets.values())) > 1_000_000 or len(sets) == 64:
                    sets.clear()
                sets[key] = shingles(text)
            return sets[key]

        for batch in in_slices(batches):
            marks = [similar(of(u, one), of(v, two)) for u, v, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(marks, type=pa.bool_()))

    joined = (pairs.join(held.select(F.col("id").alias("u"), F.col("body").alias("one")), "u")
              .join(held.select(F.col("id").alias("v"), F.col("body").alias("two")), "v"))
    return written(joined.select("u", "v", "one", "two").mapInArrow(run, "u long, v long"), "near-links")


def beyond(links: DataFrame, texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) which with the ``links`` connect all similar ``texts``. ``sets``: the ``profiles`` of the texts."""
    keys = _keys(texts)
    shared = (keys.groupBy("key").agg(F.count("*").alias("held"), F.min(F.struct("at", "id", "n")).alias("one"))
              .filter("held > 1"))
    # A text has many keys, and Spark knows only the size of its file: neither side is broadcast.
    met = written(keys.join(shared.hint("merge"), "key").select(
        "key", "id", "n", "at", F.col("one.id").alias("u"), F.col("one.n").alias("u_n"), F.col("one.at").alias("u_at")), "near-keys")
    sketches = sets.drop("fp")

    def mixed(links: DataFrame) -> DataFrame:
        """The rows of keys that hold texts of different groups, with the group."""
        roots = components(links, "near-groups").withColumnRenamed("node", "id")
        placed = met.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        open_keys = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
        return placed.join(open_keys, "key")

    stars = (mixed(links).filter((F.col("u") != F.col("id")) & _may_be_similar("n", "at", "u_n", "u_at"))
             .select(F.least("u", "id").alias("u_id"), F.greatest("u", "id").alias("v_id")).distinct())
    near = written(stars.join(_prefixed(sketches, "u_"), "u_id").join(_prefixed(sketches, "v_"), "v_id").filter(_near("u_", "v_"))
                   .select(F.col("u_id").alias("u"), F.col("v_id").alias("v")), "near-stars")
    found = verified(near, texts)
    rest = written(mixed(links.unionByName(found)).select("key", "id", "at", "root").join(sketches, "id"), "near-rest")
    one, other = _prefixed(rest, "u_", ("key",)), _prefixed(rest, "v_", ("key",))
    pairs = (one.join(other, ["key"]).filter(
        (F.col("u_id") < F.col("v_id")) & (F.col("u_root") != F.col("v_root")) & _may_be_similar("u_n", "u_at", "v_n", "v_at") & _near("u_", "v_"))
        .select(F.col("u_id").alias("u"), F.col("v_id").alias("v")).join(near, ["u", "v"], "left_anti"))
    return found.unionByName(verified(pairs, texts))
