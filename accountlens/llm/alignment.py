"""Alignment of two tokenisations of the same texts: which token ids of one stand for which ids of the other.

A is a byte-level BPE over a space and the text, B a SentencePiece BPE over the text, which adds the space itself; both
end at bytes of the same string. Bytes where tokens of A and B both end cut them into groups, and every A token of a group
is linked to every B token of it.

Each text is tokenised whole by both. Anchors are bytes where both have an end and both next tokens start with a
space; that the ends are shared is verified on the bytes of all tokens. Anchors split a document into windows, mostly words.
How a window is aligned (groups, links) depends on its two tuples of ids alone, so it is worked out once for each pair of
tuples and remembered by them, in a table of some ``KEEP`` tokens in each Python worker, emptied when full. The new windows of a batch of
texts are aligned together in arrays.

A corpus-wide count belongs to each pair of ids: in how many documents it is linked. Each document's distinct
pairs are written once, as ids and numbers of links, with the document's own columns. They are counted in the tasks
first and summed by pair. The most frequent pairs, at most ``NEAR`` of them whatever the corpus, are broadcast and
looked up where the documents are; all other pairs are joined by pair, and their sums added. Nothing is left out.

Defined cases: null and empty texts, texts that are no UTF-8, and texts that a tokeniser does not spell out byte by byte have no tokens: zeros
and an empty digest; repeated rows are documents of their own; ids of documents are carried, so they may be null; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accountlens.llm.common import as_bytes, in_slices, read_table, written

#: Tokens of the windows that a worker remembers.
KEEP = 1_500_000
#: Most pairs that are broadcast.
NEAR = 1 << 18
#: Bytes of text in hand at a time, and pairs that a task counts before it sends them on.
SLICE = 500_000
HELD = 1 << 20
#: Buckets of counts to an octave, for choosing which pairs are frequent.
OCTAVE = 16


@dataclass(frozen=True)
class Files:
    """The tokenisers' files, as bytes, so that executors need no path: A's vocabulary and its words' pattern, and B's model."""

    vocabulary: bytes
    pattern: str
    model: bytes


def byte_level(entry: str) -> bytes:
    """The bytes of an entry of a byte-level vocabulary, in which each byte is written as a printable character."""
    return bytes(_BYTES[c] for c in entry)


def _byte_characters() -> dict[str, int]:
    """Bytes that print stand for themselves; the others are numbered from 256 on."""
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


_BYTES = _byte_characters()


class Tokenisers:
    """Both tokenisers, and the bytes of each of their ids."""

    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        vocabulary = json.loads(files.vocabulary)
        special = {t["content"] for t in vocabulary.get("added_tokens", [])}
        entries = vocabulary["model"]["vocab"]
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = entry.encode() if entry in special else byte_level(entry)
        # Ids are ranks in order of merging, so the vocabulary is all that the library needs.
        ranks = {self.a_bytes[i]: i for entry, i in entries.items() if entry not in special}
        self.a = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B of each text; none where one of the two does not spell the text out."""
        words = []
        for t in texts:
            try:
                words.append(t.decode())
            except UnicodeDecodeError:
                words.append("")
        left, right = [], self.b.encode(words, num_threads=1) if words else []
        for k, (raw, text) in enumerate(zip(texts, words, strict=True)):
            a, b, whole = self.a.encode_ordinary(" " + text) if text else [], right[k], b" " + raw
            if not a or b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
                a, right[k] = [], []
            left.append(a)
        return left, right


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ranges of so many places, one range after the other, and the range that each belongs to."""
    of = np.repeat(np.arange(len(begin)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[of], of


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


@dataclass
class Batch:
    """Texts: tokens, groups, links, digest of the groups of each; distinct pairs (a << 32 | b) and their links, text by text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    edges: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


class Aligner:
    def __init__(self, files: Files, keep: int = KEEP):
        t = self.tokenisers = Tokenisers(files)
        self.keep, self.wide = keep, len(t.b_bytes)
        ids = max(len(t.a_bytes), len(t.b_bytes))
        #: Ids as text with what follows them: a comma, a bar behind the last of A in a group, a semicolon behind the last of B.
        self.names = [f"{i}{after}" for after in ",|;" for i in range(ids)]
        self.bar, self.end = ids, 2 * ids
        self.forget()

    def forget(self) -> None:
        #: Windows by their ids, and for each its groups as text, their number, the number of links, and where its pairs stand.
        self.known: dict[bytes, int] = {}
        self.texts: list[str] = []
        none = np.zeros(0, np.int64)
        self.groups, self.totals, self.begins, self.sizes, self.codes, self.links = [none] * 6
        self.held = 0

    def _cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin: tokens of both that start with a space at the same byte, as every text does."""
        t = self.tokenisers
        a_at, b_at = np.flatnonzero(t.a_space[a]), np.flatnonzero(t.b_space[b])
        a_size, b_size = t.a_size[a], t.b_size[b]
        _, i, j = np.intersect1d((np.cumsum(a_size) - a_size)[a_at], (np.cumsum(b_size) - b_size)[b_at], assume_unique=True, return_indices=True)
        return a_at[i], b_at[j]

    def _learn(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> None:
        """Align new windows, given as tokens one window after the other and tokens a window."""
        t = self.tokenisers
        a_end, b_end = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
        at = np.searchsorted(b_end, a_end)
        a_last = b_end[at] == a_end
        b_last = np.zeros(len(b), bool)
        b_last[at[a_last]] = True
        # Groups of tokens, and windows of groups.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        n_a, n_b = np.bincount(a_group), np.bincount(b_group)
        window = np.repeat(np.arange(len(a_sizes)), a_sizes)[a_last]
        # Ids as text, group by group, first those of A.
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[a_group]] = a + np.where(a_last, self.bar, 0)
        codes[np.arange(len(b)) + np.cumsum(n_a)[b_group]] = b + np.where(b_last, self.end, 0)
        names, spelt = self.names, []
        written_out = [names[c] for c in codes.tolist()]
        ends = np.cumsum(a_sizes + b_sizes).tolist()
        for begin, end in zip([0, *ends], ends, strict=False):
            spelt.append("".join(written_out[begin:end])[:-1])
        # Links: each A of a group with each B. Long groups repeat ids, so these are counted before they are combined.
        sizes = n_a * n_b
        short = sizes <= 4096
        k, group = _ranges(np.zeros(short.sum(), np.int64), sizes[short])
        group = np.flatnonzero(short)[group]
        a_from, b_from = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        area = len(t.a_bytes) * self.wide
        keys = [window[group] * area + a[a_from[group] + k // n_b[group]] * self.wide + b[b_from[group] + k % n_b[group]]]
        weights = [np.ones(len(k), np.int64)]
        for g in np.flatnonzero(~short).tolist():
            x, n = np.unique(a[a_from[g]:a_from[g] + n_a[g]], return_counts=True)
            y, m = np.unique(b[b_from[g]:b_from[g] + n_b[g]], return_counts=True)
            keys.append((window[g] * area + x[:, None] * self.wide + y[None, :]).ravel())
            weights.append((n[:, None] * m[None, :]).ravel())
        key, links = _summed(np.concatenate(keys), np.concatenate(weights))
        per_window = np.bincount(key // area, minlength=len(a_sizes))
        self.texts += spelt
        self.groups = np.append(self.groups, np.bincount(window, minlength=len(a_sizes)))
        totals = np.zeros(len(a_sizes), np.int64)
        np.add.at(totals, window, sizes)
        self.totals = np.append(self.totals, totals)
        self.begins = np.append(self.begins, np.cumsum(per_window) - per_window + len(self.codes))
        self.sizes = np.append(self.sizes, per_window)
        self.codes, self.links = np.append(self.codes, key % area), np.append(self.links, links)
        self.held += len(a) + len(b)

    def align_texts(self, texts: list[bytes]) -> Batch:
        if self.held > self.keep:
            self.forget()
        left, right = self.tokenisers.encode(texts)
        n_a, n_b = (np.array([len(x) for x in y], np.int64) for y in (left, right))
        a, b = (np.fromiter(itertools.chain.from_iterable(y), np.int64, int(n.sum())) for y, n in ((left, n_a), (right, n_b)))
        del left, right
        n = len(texts)
        if not len(a):
            none = np.zeros(n, np.int64)
            return Batch(n_a, n_b, none, none, [""] * n, np.zeros(n + 1, np.int64), none[:0], none[:0])
        a_from, b_from = self._cuts(a, b)
        a_to, b_to = np.append(a_from[1:], len(a)), np.append(b_from[1:], len(b))
        # The tuples of ids as bytes, those of B in numbers of their own.
        a_raw, b_raw = a.astype("<i4").tobytes(), (b + (1 << 30)).astype("<i4").tobytes()
        known, windows, new, fresh = self.known, [], [], len(self.texts)
        for k, (i, j, u, v) in enumerate(zip((4 * a_from).tolist(), (4 * a_to).tolist(), (4 * b_from).tolist(), (4 * b_to).tolist(), strict=True)):
            key = a_raw[i:j] + b_raw[u:v]
            found = known.get(key)
            if found is None:
                found = known[key] = fresh + len(new)
                new.append(k)
            windows.append(found)
        if new:
            sizes = [(to - begin)[new] for begin, to in ((a_from, a_to), (b_from, b_to))]
            self._learn(a[_ranges(a_from[new], sizes[0])[0]], b[_ranges(b_from[new], sizes[1])[0]], *sizes)
        # Back to texts.
        window = np.array(windows)
        text = np.searchsorted(np.cumsum(n_a), a_from, side="right")
        n_groups, n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(n_groups, text, self.groups[window])
        np.add.at(n_links, text, self.totals[window])
        spelt, digests, at = self.texts, [], 0
        for count, tokens in zip(np.bincount(text, minlength=n).tolist(), n_a.tolist(), strict=True):
            digests.append(hashlib.sha256(";".join([spelt[w] for w in windows[at:at + count]]).encode()).hexdigest() if tokens else "")
            at += count
        place, of = _ranges(self.begins[window], self.sizes[window])
        area = len(self.tokenisers.a_bytes) * self.wide
        key, links = _summed(text[of] * area + self.codes[place], self.links[place])
        edges = np.concatenate([[0], np.cumsum(np.bincount(key // area, minlength=n))])
        code = key % area
        return Batch(n_a, n_b, n_groups, n_links, digests, edges, code // self.wide << 32 | code % self.wide, links)


@lru_cache(maxsize=1)
def aligner(files: Files) -> Aligner:
    """One for each Python worker."""
    return Aligner(files)


def _kinds(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def aligned(docs: DataFrame, files: Files) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and lists a, b, links of the distinct pairs of each document."""
    known = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select("doc_id", as_bytes().alias("body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = _kinds(f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "a array<int>, b array<int>, links array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(known.value)
        for batch in in_slices(batches, limit=SLICE):
            f = own.align_texts(batch.column(1).to_pylist())
            edges = pa.array(f.edges.astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (f.pairs >> 32, f.pairs & 0xFFFFFFFF, f.links)]
            numbers = [pa.array(x) for x in (f.n_a, f.n_b, f.n_groups, f.n_links)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(f.digests, pa.string()), *lists], names=out.names)

    return rows.mapInArrow(run, out)


def _flat(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and links of each pair in the lists a, b and links, which stand from column ``first`` on."""
    lists = [batch.column(first + i) for i in range(3)]
    sizes = np.diff(lists[0].offsets.to_numpy())
    a, b, links = (x.flatten().to_numpy().astype(np.int64) for x in lists)
    return np.repeat(np.arange(batch.num_rows), sizes), a << 32 | b, links


def pair_counts(found: DataFrame, held: int = HELD) -> DataFrame:
    """(a, b, n, best): in how many documents a pair is linked, and whether that is the most of its a. ``found``: ``aligned``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *waiting])
            weight = np.concatenate([counts, np.ones(len(every) - len(keys), np.int64)])
            pairs, at = np.unique(every, return_inverse=True)
            return pairs, np.bincount(at, weight, len(pairs)).astype(np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            _, pairs, _ = _flat(batch, 0)
            waiting.append(pairs)
            size += len(pairs)
            if size >= held:
                keys, counts = merged()
                waiting, size = [], 0
                if len(keys) >= held:
                    yield rows()
                    keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield rows()

    counted = (found.select("a", "b", "links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
               .select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "n"))
    counted = written(counted, "alignment-counts")
    # One row for each id of A.
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, near: int = NEAR) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The most frequent pairs, at most ``near``, in order; their counts; whether they are best; and the bucket of counts they begin at."""
    bucket = F.floor(OCTAVE * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = sorted(((r.bucket, r.pairs) for r in counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("pairs")).collect()), reverse=True)
    first, total = 1 << 30, 0
    for value, size in sizes:
        if total + size > near:
            break
        first, total = value, total + size
    rows = counts.filter(bucket >= first).toArrow()
    a, b, n = (rows[c].to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    order = np.argsort(a << 32 | b)
    return (a << 32 | b)[order], n[order], rows["best"].to_numpy(zero_copy_only=False).astype(bool)[order], first


def alignment_report(docs: DataFrame, files: Files, near: int = NEAR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    found = written(aligned(docs, files).withColumn("row", F.monotonically_increasing_id()), "alignment-documents")
    counts = written(pair_counts(found), "alignment-pairs")
    *table, first = frequent(counts, near)
    known = docs.sparkSession.sparkContext.broadcast(table)
    numbers = "n_best long, count_sum long, a array<int>, b array<int>, links array<int>"
    out = StructType([*found.select(*own, "row").schema, *_kinds(numbers)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, best = known.value
        for batch in batches:
            n = batch.num_rows
            row, pairs, links = _flat(batch, len(own) + 1)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            # Whole numbers: a sum in doubles would lose digits.
            sums, bests = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(sums, row[hit], values[at[hit]] * links[hit])
            np.add.at(bests, row[hit], np.where(best[at[hit]], links[hit], 0))
            edges = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=n))]).astype(np.int32))
            rest = [pa.ListArray.from_arrays(edges, pa.array(x[~hit].astype(np.int32))) for x in (pairs >> 32, pairs & 0xFFFFFFFF, links)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(own) + 1], pa.array(bests), pa.array(sums), *rest], names=out.names)

    looked = written(found.select(*own, "row", "a", "b", "links").mapInArrow(look, out), "alignment-looked")
    rare = looked.filter(F.size("a") > 0).select("row", F.explode(F.arrays_zip("a", "b", "links")).alias("p")).select("row", "p.*")
    sums = (rare.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("links")).alias("more_sum")))
    return looked.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def default_files() -> Files:
    import public_tokenizers

    def read(name: str) -> bytes:
        with open(public_tokenizers.path(name), "rb") as f:
            return f.read()

    return Files(read("byte_bpe_50k.json"), public_tokenizers.PATTERN, read("piece_bpe_32k.model"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(read_table(spark, sf_dir, "documents"), default_files())
