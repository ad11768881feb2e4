"""SimHash near-dedup: block keys find the candidates, pivot distances discard some of them, bits decide.

A text becomes 64 bits: each word shingle is hashed (XXH64), and a bit is set if it is set in over half of the hashes.
Two texts are linked when their fingerprints differ in at most ``max_bits`` bits.

Links are found in two steps:

* Block keys. The 64 bits are cut into ``blocks`` blocks. Two fingerprints at a distance of at most 3 are equal in all
  but three blocks at most. Every choice of ``blocks - 3`` blocks is therefore one table, keyed by their bits, and
  linked fingerprints meet under at least one key. Fingerprints alone under their key are discarded.
* Pivots, ``PIVOTS`` fixed fingerprints. For those that meet, the distances to each pivot are compared: by the
  triangle inequality a pair with a coordinate difference over ``max_bits`` cannot be linked and is discarded. The
  survivors are verified bit by bit.

Only distinct fingerprints take part, each once, so exact copies cost one row in all. A key with more than
``UNIT`` fingerprints is dealt out: its fingerprints are split into parts, each pair of parts is a unit of its own,
and a unit returns a spanning forest of its links, never the pairs. Components are then joined up from the forests.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer
words than a shingle make one shingle; repeated rows are members of the same component; a null id never becomes the
component id unless a component has no other. An empty table gives an empty result.

The pipeline's stage (``keep_one``) takes the same steps with its own numbers: fingerprints of the sets of five-word
shingles, links of ``NEAR_BITS`` bits or fewer from block keys and pivots, verified to a similarity of 0.8 on the sets.
Similar sets may differ in more bits; ``near_copies.beyond`` finds the links that are then missing, so none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm import near_copies
from accountlens.llm.common import map_texts, read_table, written
from accountlens.llm.components import components
from accountlens.llm.suffixes import text_keys

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
#: Blocks of the fingerprint; the tables are keyed by all but ``MAX_BITS`` of them. More blocks: longer keys for more rows.
BLOCKS = 6
PIVOTS = 16
#: Most fingerprints that one part of a key holds; a unit compares two parts.
UNIT = 2048
#: The pipeline's bits and blocks. On the distinct texts of check_s 5,741 of the 8,999 similar pairs differ in 8 bits or fewer.
NEAR_BITS, NEAR_BLOCKS = 8, 10

#: Byte b to eight counters of one byte each, one for each bit of b.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of hashes, as an unsigned integer: the bits that over half of them have."""
    n = len(hashes)
    # 255 rows fill a counter of one byte at most.
    lanes = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(n, 8)], np.arange(0, n, 255), axis=0)
    counts = lanes.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint as an unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        hashes = np.array([digest(b" ".join(words), seed)], np.uint64)
    else:
        shingles = zip(*(words[i:] for i in range(shingle_words)))  # noqa: B905 - the shortest ends it
        hashes = np.fromiter((digest(b" ".join(s), seed) for s in shingles), np.uint64, n)
    return majority(hashes)


def fingerprints(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns and ``fp``, the fingerprint as a signed long."""
    return map_texts(docs, carry, lambda texts: [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)],
                     "fp long")


def _masks(blocks: int, max_bits: int) -> list[int]:
    """For each table the bits of its key, as signed longs."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links(fps: np.ndarray, unit: np.ndarray, part: np.ndarray, cross: np.ndarray, pivots: np.ndarray,
           max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least row that it can be reached from by links within its unit, and one that it is linked to.

    That one is the least, if any comes before the row, or else the greatest. Rows are sorted by unit.
    """
    root, first, after = (np.arange(len(fps)) for _ in range(3))
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)

    def join(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := root[root]).tobytes() != root.tobytes():
                root = up

    at = np.arange(len(fps))
    lag, pending, held = 0, [], 0
    while True:
        lag += 1
        at = at[at < len(fps) - lag]
        at = at[unit[at] == unit[at + lag]]
        if not len(at):
            break
        a = at[~cross[at] | (part[at] != part[at + lag])]
        for k in range(table.shape[1]):
            a = a[np.abs(table[a, k] - table[a + lag, k]) <= max_bits]
        a = a[np.bitwise_count(fps[a] ^ fps[a + lag]) <= max_bits]
        if len(a):
            # Lags grow, so the last to write is the farthest.
            first[a + lag], after[a] = a, a + lag
            pending.append((a, a + lag))
            held += len(a)
            if held > 200_000:
                join(*(np.concatenate(x) for x in zip(*pending, strict=True)))
                pending, held = [], 0
    if pending:
        join(*(np.concatenate(x) for x in zip(*pending, strict=True)))
    return root, np.where(first == np.arange(len(fps)), after, first)


def find_links(distinct: DataFrame, blocks: int = BLOCKS, max_bits: int = MAX_BITS, unit_size: int = UNIT,
               direct: bool = False) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` that connect all that are linked: forests, not all pairs.

    The ends of a forest's links may differ in more bits. With ``direct`` they do not; every linked fingerprint
    has a link then, but the links of one group need not connect it.
    """
    pivots = np.random.default_rng(1).integers(0, 1 << 64, PIVOTS, np.uint64, endpoint=False)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(_masks(blocks, max_bits))])).alias("k")).select("fp", "k.t", "k.key")
    shared = (keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
              .withColumn("parts", F.ceil(F.col("n") / unit_size)))
    # Spark sizes what ``explode`` makes as one row each; the hint keeps the keys, 20 or 45 a fingerprint, out of a broadcast.
    dealt = (keyed.join(shared.hint("merge"), ["t", "key"])
             .withColumn("part", F.when(F.col("parts") == 1, 0).otherwise(F.pmod(F.xxhash64("fp"), "parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
             .select("t", "key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def solve(rows: list[np.ndarray]) -> pa.RecordBatch:
            t, key, a, b, part, fp = rows
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            root, first = _links(fp.view(np.uint64), np.cumsum(new), part, a != b, pivots, max_bits)
            root = first if direct else root
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["u", "v"])

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            # The last unit may go on in the next batch.
            same = np.ones(len(rows[0]), bool)
            for c in rows[:4]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [c[cut:] for c in rows]
            if cut:
                yield solve([c[:cut] for c in rows])
        if held is not None and len(held[0]):
            yield solve(held)

    return (dealt.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b", "fp")
            .mapInArrow(run, "u long, v long").distinct())


def component_table(prints: DataFrame) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(find_links(distinct), "simhash-links").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id", "root")


def near_groups(docs: DataFrame) -> DataFrame:
    """(k1, k2, root) for each distinct text of ``docs``; near copies, and what they link, have one root."""
    texts = near_copies.distinct_texts(docs)
    sets = near_copies.profiles(texts, majority)
    # The first text of a fingerprint stands for it, the others are compared with that.
    distinct = written(sets.groupBy("fp").agg(F.min("id").alias("first")), "near-prints")
    same = sets.join(distinct, "fp").filter("id <> first").select(F.col("first").alias("u"), F.col("id").alias("v"))
    ends = [distinct.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_id")) for c in "uv"]
    linked = (find_links(distinct, NEAR_BLOCKS, NEAR_BITS, direct=True).join(ends[0], "u").join(ends[1], "v")
              .select(F.col("u_id").alias("u"), F.col("v_id").alias("v")))
    links = near_copies.verified(linked.unionByName(same), texts)
    links = links.unionByName(near_copies.beyond(links, texts, sets))
    roots = components(links, "near-groups").withColumnRenamed("node", "id")
    return texts.select("k1", "k2", "id").join(roots, "id", "left").select("k1", "k2", F.coalesce("root", "id").alias("root"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, with its own columns.

    This is the pipeline's rule, fingerprints of five-word shingles verified to a similarity of 0.8, not the query's three bits.
    A row is known by its id and its text. Of equal rows one stays; two texts under one id are two documents.
    """
    k1, k2 = text_keys()
    rows = docs.select("*", k1.alias("__k1"), k2.alias("__k2"), F.col("doc_id").isNull().alias("__none"),
                       F.coalesce("doc_id", F.lit(0)).alias("__id"))
    best = (rows.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "__none", "__id").join(near_groups(docs), ["k1", "k2"])
            .groupBy("root").agg(F.min(F.struct("__none", "__id", F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))).alias("k"))
            .select("k.*"))
    names = ["__none", "__id", "__k1", "__k2"]
    return rows.join(best, names).dropDuplicates(names).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = written(fingerprints(read_table(spark, sf_dir, "documents"), ["doc_id"]), "simhash-prints")
    return prints.join(component_table(prints), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
