"""Benchmark decontamination by greedy string tiling.

Texts become tokens (runs of word characters, lower case). A seed is the running (Karp-Rabin) hash of ``MIN_TILE``
consecutive tokens. Documents and benchmark items meet on shared seeds; a run of seeds on one diagonal is a
common string of tokens. For each document and item that meet, the longest string that overlaps nothing marked so
far is marked again and again, down to ``MIN_TILE`` tokens. An item leaks if the marked strings cover at least
``MIN_COVERAGE`` of its tokens, in whatever order the document has them.

At scale: the documents are read once, and only seeds that pass a bitmap of the benchmark's seeds leave the scan, as one
row for each text and seed. The bitmap has a fixed largest size; a larger benchmark only makes it let more seeds
through, and the join decides. A common phrase must not pair every document with every item: an item that is covered
as asked shares at least ``MIN_COVERAGE * tokens / MIN_TILE`` seeds, so the join may leave out the item's
most frequent seeds, one fewer than that, without losing a pair. Equal texts are worked on once, by a 128-bit key.

Defined cases: null and empty texts share nothing; an item of fewer than ``MIN_TILE`` tokens has no seed and cannot be
found; repeated items and rows are answered each; ids may be null. An empty table on either side gives no rows.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountlens.llm.common import as_bytes, in_slices, read_table, written
from accountlens.llm.rolling import prefix_sums, range_hashes

MIN_TILE = 5
MIN_COVERAGE = 0.6
#: Largest bitmap, in bits.
MAX_BITS = 1 << 27
#: Words hashed at a time; limits memory for a very long text.
CHUNK = 1 << 17

_GAPS = re.compile(r"[\W_]+")


def token_bytes(text: bytes) -> bytes:
    """The tokens of a text, joined by one space."""
    return _GAPS.sub(" ", text.decode("utf-8", "replace").lower()).strip().encode()


def seeds(tokens: bytes, length: int = MIN_TILE) -> np.ndarray:
    """Hashes of the runs of ``length`` tokens."""
    raw = np.frombuffer(tokens, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]])
    out = []
    for i in range(0, len(starts) - length + 1, CHUNK):
        first = starts[i:min(i + CHUNK, len(starts) - length + 1)]
        last = ends[i + length - 1:i + length - 1 + len(first)]
        total = prefix_sums(raw[first[0]:last[-1]])
        out.append(range_hashes(total, first - first[0], last - first[0]))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def tile(places: dict[int, list[int]], shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, tokens) from seed matches: item place to document places."""
    hits = {(i, d) for i, ds in places.items() for d in ds}
    heap = []
    for i, d in hits:
        if (i - 1, d - 1) not in hits:
            n = 1
            while (i + n, d + n) in hits:
                n += 1
            heap.append((-(n + shortest - 1), i, d))
    heapq.heapify(heap)
    seen_i, seen_d, tiles = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        free = [k for k in range(-n) if i + k not in seen_i and d + k not in seen_d]
        if len(free) == -n:
            tiles.append((i, d, -n))
            seen_i.update(range(i, i - n))
            seen_d.update(range(d, d - n))
            continue
        # What is left of it waits for its turn among shorter ones.
        start = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= shortest:
                    heapq.heappush(heap, (start - k, i + free[start], d + free[start]))
                start = k
    return tiles


def _item_seeds(benchmark: DataFrame, length: int) -> DataFrame:
    """(text key, tokens, place, seed) for each distinct benchmark text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(token_bytes(t), k) for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            codes = [seeds(t, length) for t, _ in found]
            counts = [len(c) for c in codes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([k for _, k in found], np.int64), counts)),
                 pa.array(np.repeat(np.array([t.count(b" ") + 1 for t, _ in found], np.int32), counts)),
                 pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts] or [np.zeros(0, np.int32)])),
                 pa.array(np.concatenate(codes or [np.zeros(0, np.int64)]))], names=["item", "tokens", "place", "seed"])

    texts = benchmark.select(F.xxhash64("text").alias("item"), as_bytes().alias("body")).dropDuplicates(["item"])
    return texts.mapInArrow(run, "item long, tokens int, place int, seed long")


def _bitmap(item_seeds: DataFrame) -> np.ndarray:
    """Bits at the top bits of each seed; at most ``MAX_BITS``, whatever the size of the benchmark."""
    n = item_seeds.count()
    bits = min(MAX_BITS, 1 << max(16, math.ceil(math.log2(256 * max(n, 1)))))
    at = F.shiftrightunsigned("seed", 64 - int(math.log2(bits)))
    rows = item_seeds.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 32 AS int)))").alias("set")).collect()
    words = np.zeros(bits // 32, np.uint32)
    for r in rows:
        words[r.word] = r.set
    return words.view(np.uint8)


def _hits(docs: DataFrame, item_seeds: DataFrame, length: int) -> DataFrame:
    """(k1, k2, seed, places) for each distinct text and each seed of it that the bitmap knows."""
    packed = _bitmap(item_seeds)
    shift = np.uint64(64 - int(math.log2(8 * len(packed))))
    known = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = known.value
        for batch in in_slices(batches):
            out = []
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = seeds(token_bytes(text), length)
                at = codes.view(np.uint64) >> shift
                hit = np.flatnonzero(bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
                if len(hit):
                    places = defaultdict(list)
                    for seed, place in zip(codes[hit].tolist(), hit.tolist(), strict=True):
                        places[seed].append(place)
                    out += [(k1, k2, s, p) for s, p in places.items()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["k1", "k2", "seed", "places"])

    rows = docs.select(*_keys(), as_bytes().alias("body")).mapInArrow(run, "k1 long, k2 long, seed long, places array<int>")
    # Equal texts give equal rows; a seed that the bitmap let through by chance meets no item.
    return rows.join(item_seeds.select("seed").distinct(), "seed", "left_semi").dropDuplicates(["k1", "k2", "seed"])


def _keys():
    return F.xxhash64(as_bytes()).alias("k1"), F.xxhash64(F.lit(1), as_bytes()).alias("k2")


def _tiled(matches: DataFrame, length: int) -> DataFrame:
    """Tiles of each (k1, k2, item): the tokens covered and the number of tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, counts = [], []
            for found in batch.column(4).to_pylist():
                tiles = tile({m["place"]: m["places"] for m in found}, length)
                covered.append(sum(n for _, _, n in tiles))
                counts.append(len(tiles))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(covered, pa.int32()), pa.array(counts, pa.int32())],
                                             names=["k1", "k2", "item", "tokens", "covered", "n_tiles"])

    return matches.mapInArrow(run, "k1 long, k2 long, item long, tokens int, covered int, n_tiles int")


def leaks(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(k1, k2, item, tokens, covered, n_tiles) for each distinct document text that leaks a distinct benchmark text."""
    item_seeds = written(_item_seeds(benchmark, min_tile), "tiling-items")
    hits = written(_hits(docs, item_seeds, min_tile), "tiling-hits")
    # The item's most frequent seeds need not be joined: a leak shares one of the others.
    frequency = hits.groupBy("seed").agg(F.count("*").alias("texts"))
    spare = F.ceil(F.col("tokens") * F.lit(min_coverage) / min_tile) - 1
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("texts"), "place"))
    rare = (item_seeds.join(frequency, "seed").withColumn("rank", rank).filter(F.col("rank") > spare)
            .select("seed", "item").distinct())
    pairs = hits.join(rare, "seed").select("k1", "k2", "item").distinct()
    matches = (hits.join(pairs, ["k1", "k2"]).join(item_seeds, ["item", "seed"])
               .groupBy("k1", "k2", "item", "tokens").agg(F.collect_list(F.struct("place", "places")).alias("matches")))
    # No more can be covered than all matching seeds span.
    open_pairs = matches.filter(F.size("matches") * min_tile >= F.col("tokens") * min_coverage)
    return _tiled(open_pairs, min_tile).filter(F.col("covered") >= F.col("tokens") * min_coverage)


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    k1, k2 = _keys()
    bad = leaks(docs, benchmark).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct()
    return docs.select("*", k1.alias("__k1"), k2.alias("__k2")).join(bad, ["__k1", "__k2"], "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it leaks."""
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = written(leaks(docs, benchmark), "tiling-leaks")
    items = benchmark.select("item_id", F.xxhash64("text").alias("item"))
    return docs.select("doc_id", *_keys()).join(found, ["k1", "k2"]).join(items, "item").select(
        "doc_id", "item_id", F.col("tokens").alias("n_tokens"), "covered", "n_tiles",
        (F.col("covered") / F.col("tokens")).alias("coverage"))
