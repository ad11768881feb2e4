"""Line dedup: lines that several documents hold stay in one document only, the one with the largest id.

A text is split at line ends. A line's key is the line without white space at both ends, A-Z in lower case. Keys of at
least ``MIN_CHARS`` code points that stand in at least ``MIN_DOCS`` documents lose all their lines but those of the
largest ``doc_id`` that holds them. Texts are not moved for that: a line is known by 128 bits of its key.

1. One row for each long line: the hash of its key, the document, and the line's place. Written once.
2. These rows are range-partitioned by hash and, within it, by document and place (secondary sort), the largest id first.
   A task streams its range: the first document of a hash is the first occurrence, which stays, and rows behind it go as
   soon as ``MIN_DOCS`` documents have been seen. A range may end anywhere, also within one hash, so a line of a third of
   all documents is spread over many tasks. What a task cannot know are the hashes at the two ends of its range: their
   rows stay open, with a summary of what the task has seen of them. There are at most two summaries a task, so
   the verdicts on them, two rows a task at most, are broadcast back to the open rows.
3. The places that go become one compressed keep bitmap a document (``keep_bitmaps``), which is all that meets the text.

Defined cases: null and empty texts are one empty line; a text whose lines all go becomes empty; documents with
a null id do not count, are never the largest, and lose the lines that go elsewhere; repeated rows of one id and text
count once and are answered alike; two texts under one id are one document; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accountlens.llm.common import SPACES, as_bytes, in_slices, read_table, written
from accountlens.llm.suffixes import text_keys

MIN_CHARS = 40
MIN_DOCS = 5

GONE, OPEN, SUMMARY = 0, 1, 2


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line, or None if it is too short to be looked at."""
    key = line.strip(SPACES)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key.lower()


def _id_kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def _line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, k1, k2, place) for each line that is long enough."""
    k1, k2 = text_keys()
    rows = docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), as_bytes().alias("body"))
    out = StructType.fromDDL(f"h1 long, h2 long, doc_id {_id_kind(docs)}, k1 long, k2 long, place int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            digests, places, counts = [], [], []
            for text in batch.column(3).to_pylist():
                before = len(places)
                for place, line in enumerate(text.split(b"\n")):
                    if len(line) >= min_chars and (key := line_key(line, min_chars)) is not None:
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(place)
                counts.append(len(places) - before)
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), *(batch.column(i).take(row) for i in range(3)),
                 pa.array(np.array(places, np.int32))], names=out.names)

    return rows.mapInArrow(run, out)


def _changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Where a value differs from the one before it; null equals null."""
    out = np.ones(len(column), bool)
    head, tail = column.slice(0, len(column) - 1), column.slice(1)
    differ = pc.fill_null(pc.not_equal(head, tail), True).to_numpy(zero_copy_only=False)
    none = pc.is_null(column).to_numpy(zero_copy_only=False)
    out[1:] = differ & ~(none[1:] & none[:-1])
    if before is not None:
        first = column[0]
        out[0] = first.is_valid != before.is_valid or (first.is_valid and first.as_py() != before.as_py())
    return out


class _Range:
    """What one task keeps while it streams its range of the sorted rows."""

    def __init__(self, names: list[str], schema: pa.Schema, min_docs: int):
        self.names, self.schema, self.min_docs = names, schema, min_docs
        self.last: list[pa.Scalar] | None = None
        #: Documents of the hash in hand, and whether it is the first hash of the range.
        self.seen, self.first_hash = 0, True
        self.newest: pa.Scalar | None = None
        self.oldest: pa.Scalar | None = None
        self.held: list[pa.RecordBatch] = []

    def _rows(self, batch: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        n = batch.num_rows
        none = pa.nulls(n, self.schema.field("oldest").type)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), *batch.columns, none, pa.nulls(n, pa.int64())], schema=self.schema)

    def summary(self) -> pa.RecordBatch:
        """The hash in hand: its documents with the largest and the least id, and how many are between them."""
        between = max(0, self.seen - 2)
        kind = self.schema.field("oldest").type
        newest, oldest = (x.as_py() if x is not None else None for x in (self.newest, self.oldest))
        h1, h2 = (x.as_py() for x in self.last[:2])
        columns = [SUMMARY, h1, h2, newest, None, None, None, oldest, between]
        kinds = [pa.int8(), pa.int64(), pa.int64(), kind, pa.int64(), pa.int64(), pa.int32(), kind, pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds, strict=True)], schema=self.schema)

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, ids = batch.num_rows, batch.column(2)
        h1, h2, doc = (_changes(batch.column(i), self.last[i] if self.last else None) for i in range(3))
        new_hash = h1 | h2
        known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        counted = np.cumsum((new_hash | doc) & known)
        group = np.cumsum(new_hash)
        begins = np.flatnonzero(new_hash)
        # Documents counted before each group; group 0 goes on from the batch before.
        base = np.concatenate([[-self.seen], np.where(begins > 0, counted[begins - 1], 0)])
        order = counted - base[group]
        ends = np.append(begins, n) - 1
        total = np.where(ends >= 0, order[ends], self.seen)
        # Group 0, and the first group of a range, may belong to the range's first hash.
        open_group = np.zeros(len(total), bool)
        open_group[0] = self.last is not None and self.first_hash
        if self.last is None:
            open_group[1] = True
        if self.last is None:
            if len(begins) > 1:
                # The first hash of the range ends within its first batch.
                self.last = [batch.column(i)[0] for i in range(3)]
                self._grow(ids.slice(0, begins[1]), known[:begins[1]], int(total[1]))
                yield self.summary()
        else:
            if len(begins) and begins[0] > 0:
                self._grow(ids.slice(0, begins[0]), known[:begins[0]], int(total[0]))
            if len(begins):
                yield from self.finish(last=False)
        mine_open = open_group[group]
        gone = ~mine_open & (order >= 2) & (total[group] >= self.min_docs)
        # The last group goes on in the next batch: what may still go is held, three documents' rows at most.
        last = group[-1]
        waits = ~mine_open & (group == last) & (order >= 2) & known & (total[last] < self.min_docs)
        for mask, kind in ((mine_open, OPEN), (gone, GONE)):
            if mask.any():
                yield self._rows(batch.filter(pa.array(mask)), kind)
        if len(begins):
            at = int(begins[-1])
            self.first_hash = bool(open_group[last])
            self.seen, self.newest, self.oldest, self.held = 0, None, None, []
            self.last = [batch.column(i)[n - 1] for i in range(3)]
            self._grow(ids.slice(at), known[at:], int(total[last]))
        else:
            self.last = [batch.column(i)[n - 1] for i in range(3)]
            self._grow(ids, known, int(total[0]))
        if waits.any():
            self.held.append(batch.filter(pa.array(waits)))
        if self.seen >= self.min_docs:
            yield from self._release()

    def _grow(self, ids: pa.Array, known: np.ndarray, total: int) -> None:
        at = np.flatnonzero(known)
        if len(at):
            self.newest = ids[int(at[0])] if self.newest is None else self.newest
            self.oldest = ids[int(at[-1])]
        self.seen = total

    def _release(self) -> Iterator[pa.RecordBatch]:
        yield from (self._rows(b, GONE) for b in self.held)
        self.held = []

    def finish(self, last: bool) -> Iterator[pa.RecordBatch]:
        """The hash in hand ends here, at the end of the range or before."""
        if self.seen >= self.min_docs:
            yield from self._release()
        elif last:
            yield from (self._rows(b, OPEN) for b in self.held)
        self.held = []
        if last or self.first_hash:
            yield self.summary()


def _verdicts(rows: DataFrame, min_docs: int) -> DataFrame:
    """Rows that go, rows that are open, and summaries of the hashes at the ends of ranges, by column ``kind``."""
    kind = _id_kind(rows)
    out = StructType.fromDDL(f"kind byte, h1 long, h2 long, doc_id {kind}, k1 long, k2 long, place int, oldest {kind}, between long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if state is None:
                id_kind = batch.schema.field(2).type
                kinds = [pa.int8(), pa.int64(), pa.int64(), id_kind, pa.int64(), pa.int64(), pa.int32(), id_kind, pa.int64()]
                state = _Range(batch.schema.names, pa.schema(list(zip(out.names, kinds, strict=True))), min_docs)
            yield from state.feed(batch)
        if state is not None:
            yield from state.finish(last=True)

    order = ["h1", "h2", F.desc_nulls_last("doc_id"), "k1", "k2", "place"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, out)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, k1, k2, place) of each line that goes; k1, k2: the key of the text. Repeated rows give repeated lines."""
    rows = written(_line_rows(docs, min_chars), "line-rows")
    found = written(_verdicts(rows, min_docs), "line-verdicts")
    # The documents at the ends of ranges may be the same in neighbouring ranges.
    seen = found.filter(F.col("kind") == SUMMARY)
    ends = (seen.select("h1", "h2", "between", F.explode(F.array("doc_id", "oldest")).alias("end"))
            .groupBy("h1", "h2").agg((F.sum("between") / 2 + F.count_distinct("end")).cast("long").alias("held"), F.max("end").alias("largest")))
    verdicts = ends.filter(F.col("held") >= min_docs).select("h1", "h2", "largest")
    closed = (found.filter(F.col("kind") == OPEN).join(F.broadcast(verdicts), ["h1", "h2"])
              .filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("largest"))))
    names = ["doc_id", "k1", "k2", "place"]
    return found.filter(F.col("kind") == GONE).select(*names).unionByName(closed.select(*names))


def pack(places: list[int]) -> bytes:
    """A compressed bitmap that keeps all lines but these; lines behind its end stay."""
    keep = np.ones(max(places) // 8 * 8 + 8, bool)
    keep[places] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes, lines: int) -> np.ndarray:
    """Which of so many lines stay."""
    keep = np.ones(lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:lines].astype(bool)
    keep[:len(bits)] = bits
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, k1, k2, keep) for each document that loses lines: a bit for each line, 0 where it goes."""
    # The lines of one text; a set, since repeated rows say the same.
    lost = dropped_lines(docs, min_chars, min_docs).groupBy("doc_id", "k1", "k2").agg(F.collect_set("place").alias("places"))
    out = StructType.fromDDL(f"doc_id {_id_kind(docs)}, k1 long, k2 long, keep binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(p) for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=out.names)

    return lost.mapInArrow(run, out)


def _beside_texts(docs: DataFrame, min_chars: int, min_docs: int, carry: list[str]) -> DataFrame:
    """``carry`` columns, then the bitmap, then the text's bytes."""
    k1, k2 = text_keys()
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).toDF("__doc", "__b1", "__b2", "__keep")
    rows = docs.select(*carry, F.col("doc_id").alias("__id"), k1.alias("__k1"), k2.alias("__k2"), as_bytes().alias("__body"))
    met = rows.join(bitmaps, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__k1") == F.col("__b1")) & (F.col("__k2") == F.col("__b2")), "left")
    return met.select(*carry, "__keep", "__body")


def _applied(text: bytes, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Lines, lines that go, and what stays of a text."""
    if bitmap is None:
        return text.count(b"\n") + 1, 0, text
    lines = text.split(b"\n")
    keep = unpack(bitmap, len(lines))
    return len(lines), int(len(lines) - keep.sum()), b"\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, and the digest of what stays."""
    out = StructType.fromDDL(f"doc_id {_id_kind(docs)}, n_lines long, n_dropped long, kept_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [_applied(t, k) for k, t in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array([d for _, d, _ in found], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for _, _, t in found], pa.string())], names=out.names)

    return _beside_texts(docs, min_chars, min_docs, ["doc_id"]).mapInArrow(run, out)


def remove_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its columns, and without the lines that go; a null text stays null."""
    out = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            *own, bitmaps, texts = batch.columns
            new = [_applied(t, k)[2] if k is not None else None for k, t in zip(bitmaps.to_pylist(), texts.to_pylist(), strict=True)]
            kept = pc.coalesce(pa.array([None if t is None else t.decode("utf-8", "replace") for t in new], own[at].type), own[at])
            own[at] = kept
            yield pa.RecordBatch.from_arrays(own, names=out.names)

    return _beside_texts(docs, min_chars, min_docs, docs.columns).mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


#: The same rule in DuckDB.
STATEMENT = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM rows),
keyed AS (
    SELECT r, doc_id, line, place, translate(
        regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
shared AS (
    SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT r, k.doc_id, line, place, coalesce(k.doc_id <> largest, false) AS gone
    FROM keyed k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
