"""Language model scores: Katz backoff over words, with Good-Turing discounts.

A text is its words and one end token; the model is of order two. A word seen r times (r at most ``CUTOFF``) counts as
Good and Turing say, more frequent ones as they are; what that takes away goes to unseen words, all of which share it
as one unknown word. After a word v, seen pairs have their discounted share, and the rest goes to the words not seen
after v in proportion to their own probability, times the backoff weight of v, computed from exact sums, so that the
probabilities after each v add up to one. A context that was never seen backs off with weight one.

Tables and passes, none of which brings a group of unbounded size to one task or anything but the counts of counts to the driver:

1. *Blocks*: each Arrow batch of documents becomes a row with its sorted vocabulary (64-bit hashes of words) and its tokens
   as places in it. The blocks are a table bucketed by block, so that later joins move only what is joined to them.
2. *Words*: vocabularies go to buckets of the hash space; each bucket adds up the counts of its words and
   answers every block with the counts of the words it asked for.
3. *Pairs*: each block sends its distinct pairs with their counts to buckets by the first word. A first word with more than
   ``HOT`` occurrences is dealt out further by the second. Each bucket adds up, answers the blocks, and returns sums for
   each first word: numbers of pairs seen 1 .. ``CUTOFF`` times, occurrences of the rest, probability of the second words.
4. *Weights*: the sums meet by first word, in the buckets of pass 2, and give the backoff weights; blocks get theirs.
5. *Scores*: each block evaluates its distinct pairs once and adds up the documents' tokens.

Buckets travel as packed arrays (sorted hashes as differences, split into byte planes, compressed), a few bytes an entry.

Defined cases: null and empty texts are the end token alone; a null id is neither learnt from nor held out; repeated rows
count each time; without training texts every token is unknown with probability one. Texts of any length are whole; a block
holds one at least.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import as_bytes, crc_bucket, in_slices, read_table, shared_folder, written
from accountlens.llm.rolling import prefix_sums, range_hashes

CUTOFF = 5
#: Occurrences of a first word from which its pairs are dealt out by the second word as well.
HOT = 1_000_000
BLOCK_BYTES = 8_000_000
#: Entries for one bucket, about.
BUCKET = 500_000

_BEGIN = np.uint64(0xFFFFFFFFFFFFFFFF)
_CHUNK = 1 << 17


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: small ones take little."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def discounts(seen: list[int], cutoff: int = CUTOFF) -> np.ndarray:
    """What an item seen r times counts for, divided by r, at place r; ``seen``: items seen 1 .. cutoff + 1 times.

    Where the Good-Turing estimate isn't between 0 and 1, half an occurrence is taken off.
    """
    n = [0, *seen]
    out = np.ones(cutoff + 1)
    tail = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] else 1.0
    for r in range(1, cutoff + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


@dataclass
class Words:
    """The lower order: N tokens, V distinct ones, and how many were seen 1 .. cutoff + 1 times."""

    tokens: int
    distinct: int
    seen: list[int]

    def __post_init__(self):
        self.discount = discounts(self.seen)
        low = np.arange(1, CUTOFF + 1)
        kept = self.tokens - float(((1 - self.discount[1:]) * low * np.array(self.seen[:CUTOFF])).sum())
        # Without a rare word nothing is taken off: the unknown word then gets one occurrence.
        self.total = self.tokens if self.tokens - kept > 1e-9 else self.tokens + 1
        self.unknown = 1 - kept / self.total if self.tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        factor = np.where(counts <= CUTOFF, self.discount[np.minimum(counts, CUTOFF).astype(np.int64)], 1.0)
        return np.where(counts > 0, factor * c / max(self.total, 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts.astype(np.float64) + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words of some texts, the end token's among them, and all tokens as places in it."""
    joined = b" ".join(p for t in texts for p in (b" ".join(t.lower().split()), b"\n") if p)
    raw = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]])
    codes = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), _CHUNK):
        a, b = starts[i:i + _CHUNK], ends[i:i + _CHUNK]
        codes[i:i + _CHUNK] = range_hashes(prefix_sums(raw[a[0]:b[-1]]), a - a[0], b - a[0])
    # No word is the begin of a text.
    return np.unique(np.minimum(codes, _BEGIN - np.uint64(1)), return_inverse=True)


END = tokens_of([b""])[0][0]


def _blocks(docs: DataFrame, trains: Column, held: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(b for b in in_slices(batches, limit=BLOCK_BYTES) if b.num_rows):
            ids, train, held_out, texts = (c.to_pylist() for c in batch.columns)
            vocabulary, codes = tokens_of(texts)
            lengths = np.diff(np.flatnonzero(codes == np.searchsorted(vocabulary, END)), prepend=-1)
            counts = np.bincount(codes[np.repeat(np.array(train), lengths)], minlength=len(vocabulary))
            yield pa.RecordBatch.from_pylist([{
                "block": (TaskContext.get().partitionId() << 32) + number, "n_words": len(vocabulary), "n_tokens": len(codes),
                "ids": ids, "train": train, "held_out": held_out, "lengths": pack(lengths), "codes": pack(codes),
                "vocabulary": pack_sorted(vocabulary), "counts": pack(counts)}], schema=kinds)

    kinds = pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64())),
                       ("train", pa.list_(pa.bool_())), ("held_out", pa.list_(pa.bool_())),
                       *((c, pa.binary()) for c in ("lengths", "codes", "vocabulary", "counts"))])
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(trains, F.lit(False)).alias("train"),
                       F.coalesce(held, F.lit(False)).alias("held_out"), as_bytes().alias("body")).mapInArrow(
        run, "block long, n_words long, n_tokens long, ids array<long>, train array<boolean>, held_out array<boolean>, "
             "lengths binary, codes binary, vocabulary binary, counts binary")


def _bucketed(df: DataFrame, n: int) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder with ``n`` buckets by block, and the table's name."""
    spark = df.sparkSession
    name = f"lm_blocks_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", f"{shared_folder(spark)}/llm/{name}").bucketBy(n, "block").saveAsTable(name)
    return spark.table(name), name


def _ranges(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of sorted hashes with equal top bits."""
    of = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(of[a]), a, b


def _asked_words(blocks: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, first, hashes, counts): the vocabulary of each block, with the begin mark last, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, vocabulary, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, n = np.append(unpack_sorted(vocabulary), _BEGIN), np.append(unpack(counts), np.uint64(0))
                rows += [(bucket, block, a, pack_sorted(hashes[a:b]), pack(n[a:b])) for bucket, a, b in _ranges(hashes, bits)]
            yield _batch(rows, [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["bucket", "block", "first", "hashes", "counts"])

    return blocks.select("block", "vocabulary", "counts").mapInArrow(
        run, "bucket int, block long, first long, hashes binary, counts binary")


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)


_ANSWER = "bucket long, block long, first long, answer binary, stats array<long>"
_ANSWER_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
_ANSWER_NAMES = ["bucket", "block", "first", "answer", "stats"]


def _counted_words(asked: DataFrame) -> DataFrame:
    """Answers with the counts of the words asked for, and a row of counts of counts for each bucket."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [unpack_sorted(r["hashes"]) for r in rows]
        _, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(int(at.max()) + 1, np.int64)
        np.add.at(total, at, np.concatenate([unpack(r["counts"]) for r in rows]).astype(np.int64))
        out, begin = [], 0
        for r, h in zip(rows, hashes, strict=True):
            out.append((r["bucket"], r["block"], r["first"], pack(total[at[begin:begin + len(h)]]), None))
            begin += len(h)
        seen = np.bincount(np.minimum(total, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].tolist()
        out.append((rows[0]["bucket"], None, None, None, [int(total.sum()), int((total > 0).sum()), *seen]))
        return pa.Table.from_batches([_batch(out, _ANSWER_KINDS, _ANSWER_NAMES)])

    return asked.groupBy("bucket").applyInArrow(run, _ANSWER)


def _stats(answers: DataFrame, n: int) -> list[int]:
    row = answers.filter("stats IS NOT NULL").agg(*[F.sum(F.col("stats")[i]) for i in range(n)]).first()
    return [int(x or 0) for x in row]


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.filter("block IS NOT NULL").groupBy("block").agg(
        F.collect_list(F.struct("first", "bucket", "answer")).alias(name))


def _in_order(answers: list[dict]) -> np.ndarray:
    return np.concatenate([unpack(a["answer"]) for a in sorted(answers, key=lambda a: a["first"])])


class _Pairs:
    """The distinct pairs of a block, in the order of first and second word, and the bucket of each."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, counts: np.ndarray, bits: int, train_texts: int):
        size = len(hashes)
        before = np.empty(len(codes), np.int64)
        before[1:] = codes[:-1]
        before[np.cumsum(lengths) - lengths] = size - 1
        self.keys, self.at = np.unique(before * size + codes, return_inverse=True)
        del before
        self.first, self.second = self.keys // size, self.keys % size
        # A context occurs as often as its word; the begin mark as often as there are texts.
        self.context = counts[self.first].astype(np.int64)
        self.context[self.first == size - 1] = train_texts
        v, w = hashes[self.first], hashes[self.second]
        bucket = (v >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(v), np.int64)
        parts = -(-self.context // HOT)
        hot = np.flatnonzero(parts > 1)
        if len(hot):
            part = w[hot] % parts[hot].astype(np.uint64)
            own = v[hot] * np.uint64(0x9E3779B97F4A7C15) + part * np.uint64(0xD6E8FEB86659FD93)
            bucket[hot] = -1 - (own >> np.uint64(2)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
        self.groups = [(int(bucket[order[a]]), order[a:b]) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _asked_pairs(blocks: DataFrame, bits: int, train_texts: int) -> DataFrame:
    """(bucket, block, runs, firsts, seconds, counts, words): the pairs of each block, by bucket."""
    names = ["bucket", "block", "firsts", "runs", "seconds", "counts", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                hashes = np.append(unpack_sorted(row["vocabulary"]), _BEGIN)
                words, lengths = _in_order(row["words"]), unpack(row["lengths"]).astype(np.int64)
                pairs = _Pairs(unpack(row["codes"]).astype(np.int64), lengths, hashes, words, bits, train_texts)
                learnt = np.repeat(np.array(row["train"]), lengths)
                counts = np.bincount(pairs.at[learnt], minlength=len(pairs.keys))
                out = []
                for bucket, at in pairs.groups:
                    v, w = hashes[pairs.first[at]], hashes[pairs.second[at]]
                    new = np.concatenate([[True], v[1:] != v[:-1]])
                    # Second words rise within a first word; each run starts anew.
                    steps = np.diff(w, prepend=np.uint64(0))
                    steps[new] = w[new]
                    runs = np.diff(np.append(np.flatnonzero(new), len(v)))
                    out.append((bucket, row["block"], pack_sorted(v[new]), pack(runs), pack(steps), pack(counts[at]),
                                pack(words[pairs.second[at]])))
                yield _batch(out, [pa.int64(), pa.int64(), *[pa.binary()] * 5], names)

    return blocks.select("block", "train", "lengths", "codes", "vocabulary", "words").mapInArrow(
        run, "bucket long, block long, firsts binary, runs binary, seconds binary, counts binary, words binary")


def _unpack_pairs(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    runs = unpack(r["runs"]).astype(np.int64)
    v = np.repeat(unpack_sorted(r["firsts"]), runs)
    total = np.cumsum(unpack(r["seconds"]), dtype=np.uint64)
    starts = np.cumsum(runs) - runs
    steps_before = np.where(starts > 0, total[np.maximum(starts, 1) - 1], np.uint64(0))
    return v, total - np.repeat(steps_before, runs), unpack(r["counts"]).astype(np.int64), unpack(r["words"])


def _counted_pairs(asked: DataFrame, words: Words, bits: int) -> DataFrame:
    """Answers with the counts of the pairs asked for, counts of counts, and sums for each first word."""
    names = [*_ANSWER_NAMES, "word_bucket", "firsts", "sums", "mass"]
    kinds = [*_ANSWER_KINDS, pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [_unpack_pairs(r) for r in rows]
        v, w, n, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        key = (v ^ (v >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + w
        _, one, at = np.unique(key, return_index=True, return_inverse=True)
        total = np.zeros(len(one), np.int64)
        np.add.at(total, at, n)
        out, begin = [], 0
        for r, part in zip(rows, parts, strict=True):
            out.append((r["bucket"], r["block"], None, pack(total[at[begin:begin + len(part[0])]]), None, None, None, None, None))
            begin += len(part[0])
        seen = np.bincount(np.minimum(total, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].tolist()
        out.append((rows[0]["bucket"], None, None, None, seen, None, None, None, None))
        learnt = total > 0
        firsts, of = np.unique(v[one][learnt], return_inverse=True)
        total, p = total[learnt], words.probability(c[one][learnt])
        sums = np.zeros((CUTOFF + 1, len(firsts)), np.int64)
        low = total <= CUTOFF
        np.add.at(sums, (total[low] - 1, of[low]), 1)
        np.add.at(sums[CUTOFF], of[~low], total[~low])
        mass = np.bincount(of, p, len(firsts))
        for bucket, a, b in _ranges(firsts, bits):
            out.append((rows[0]["bucket"], None, None, None, None, bucket, pack_sorted(firsts[a:b]), pack(sums[:, a:b].ravel()),
                        mass[a:b].tobytes()))
        return pa.Table.from_batches([_batch(out, kinds, names)])

    return asked.groupBy("bucket").applyInArrow(
        run, f"{_ANSWER}, word_bucket int, firsts binary, sums binary, mass binary")


def backoff(sums: np.ndarray, mass: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weights of contexts and what their counts are divided by, from the sums of pass 3."""
    low = np.arange(1, CUTOFF + 1)[:, None]
    seen = (sums[:-1] * low).sum(0) + sums[-1]
    kept = (sums[:-1] * low * discount[1:, None]).sum(0) + sums[-1]
    # A context without a rare pair has nothing left: its unseen words then get one occurrence.
    divisor = np.where(seen - kept > 1e-9, seen, seen + 1)
    return (1 - kept / divisor) / (1 - mass), divisor


def _weights(asked: DataFrame, pairs: DataFrame, discount: np.ndarray) -> DataFrame:
    """Answers with the backoff weight of each word asked for: negative if one occurrence was added to its context."""
    requests = asked.select("bucket", "block", "first", "hashes", F.lit(None).cast("binary").alias("sums"),
                            F.lit(None).cast("binary").alias("mass"))
    found = pairs.filter("word_bucket IS NOT NULL").select(
        F.col("word_bucket").alias("bucket"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("first"),
        F.col("firsts").alias("hashes"), "sums", "mass")

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sums = [r for r in rows if r["block"] is None]
        asks = [r for r in rows if r["block"] is not None]
        if sums:
            hashes, at = np.unique(np.concatenate([unpack_sorted(r["hashes"]) for r in sums]), return_inverse=True)
            every = np.concatenate([unpack(r["sums"]).astype(np.int64).reshape(CUTOFF + 1, -1) for r in sums], 1)
            total = np.zeros((CUTOFF + 1, len(hashes)), np.int64)
            for k in range(CUTOFF + 1):
                np.add.at(total[k], at, every[k])
            # Parts of a hot word come in any order; sorted, their sum is always the same.
            mass = np.concatenate([np.frombuffer(r["mass"]) for r in sums])
            order = np.lexsort((mass, at))
            weight, divisor = backoff(total, np.bincount(at[order], mass[order], len(hashes)), discount)
            weight = np.where(divisor > (total[:-1] * np.arange(1, CUTOFF + 1)[:, None]).sum(0) + total[-1], -weight, weight)
        else:
            hashes, weight = np.zeros(0, np.uint64), np.zeros(0)
        hashes, weight = np.append(hashes, _BEGIN), np.append(weight, 1.0)
        out = []
        for r in asks:
            h = unpack_sorted(r["hashes"])
            at = np.searchsorted(hashes, h)
            out.append((r["bucket"], r["block"], r["first"], pack(np.where(hashes[at] == h, weight[at], 1.0).view(np.uint64)), None))
        return pa.Table.from_batches([_batch(out, _ANSWER_KINDS, _ANSWER_NAMES)])

    return requests.unionByName(found).groupBy("bucket").applyInArrow(run, _ANSWER)


def _scores(blocks: DataFrame, words: Words, discount: np.ndarray, bits: int, train_texts: int) -> DataFrame:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                hashes = np.append(unpack_sorted(row["vocabulary"]), _BEGIN)
                counts, lengths = _in_order(row["words"]), unpack(row["lengths"]).astype(np.int64)
                weights = _in_order(row["weights"]).view(np.float64)
                codes = unpack(row["codes"]).astype(np.int64)
                pairs = _Pairs(codes, lengths, hashes, counts, bits, train_texts)
                answers = {a["bucket"]: a["answer"] for a in row["pairs"]}
                seen = np.zeros(len(pairs.keys), np.int64)
                for bucket, at in pairs.groups:
                    seen[at] = unpack(answers[bucket])
                weight = weights[pairs.first]
                factor = np.where(seen <= CUTOFF, discount[np.minimum(seen, CUTOFF)], 1.0)
                held = factor * seen / np.maximum(pairs.context + (weight < 0), 1)
                rest = np.where(pairs.context > 0, np.abs(weight), 1.0) * words.probability(counts[pairs.second])
                logs = np.log10(np.where(seen > 0, held, rest))
                begin = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip((
                    row["ids"], row["held_out"], lengths, np.add.reduceat((counts[codes] > 0).astype(np.int64), begin),
                    np.full(len(lengths), words.tokens), np.add.reduceat(words.base(counts)[codes], begin),
                    np.add.reduceat(logs[pairs.at], begin)), kinds, strict=True)], names=names)

    return blocks.select("ids", "held_out", "lengths", "codes", "vocabulary", "words", "pairs", "weights").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _bits(entries: int) -> int:
    return max(0, math.ceil(math.log2(max(1, entries / BUCKET))))


def score_documents(docs: DataFrame, trains: Column, held: Column) -> DataFrame:
    """Scores of all documents under a model learnt from those that ``trains`` marks."""
    spark = docs.sparkSession
    n = max(4 * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks, table = _bucketed(_blocks(docs, trains, held), n)
    sizes = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum(F.aggregate(
        F.transform("train", lambda t: t.cast("long")), F.lit(0).cast("long"), lambda a, t: a + t))).first()
    n_words, n_tokens, train_texts = (int(x or 0) for x in sizes)
    word_bits = _bits(n_words)
    pair_bits = max(word_bits, _bits(n_tokens))
    asked = _asked_words(blocks, word_bits)
    counted = written(_counted_words(asked), "lm-words")
    tokens, distinct, *seen = _stats(counted, CUTOFF + 3)
    words = Words(tokens, distinct, seen)
    known = blocks.join(_by_block(counted, "words"), "block")
    pairs = written(_counted_pairs(_asked_pairs(known, pair_bits, train_texts), words, word_bits), "lm-pairs")
    discount = discounts(_stats(pairs, CUTOFF + 1))
    weights = written(_weights(asked, pairs, discount), "lm-weights")
    complete = known.join(_by_block(pairs, "pairs"), "block").join(_by_block(weights, "weights"), "block")
    scores = written(_scores(complete, words, discount, pair_bits, train_texts), "lm-scores")
    spark.sql(f"DROP TABLE {table}")
    return scores


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's remainder is not 0, and scores all."""
    rest = crc_bucket("doc_id", 10)
    return score_documents(read_table(spark, sf_dir, "documents"), rest != 0, rest == 0)
