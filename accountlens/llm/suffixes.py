"""Exact substring dedup: windows are grouped by anchor, then by hash; equal groups are the repeated windows.

A window is a string of ``WINDOW`` bytes. A byte goes if a window that covers it also starts anywhere else, in the same
text or another. No suffix is ordered: three passes of hashes find the windows that fall into a group of two or more,
each looking only at the groups that the passes before left open:

1. The anchor of a window, the ``GRAM`` bytes in it whose hash is least (the leftmost of equals). Equal
   windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so a text becomes a
   short list of segments, runs of window starts with one anchor. A segment whose anchor is in no other is done.
2. The whole string that a segment's windows cover. Segments with equal strings hold equal windows
   throughout: all of them repeat, and are done.
3. The windows one by one, only for the strings that stand alone under a shared anchor, against one
   representative of each other string under it. Only these strings travel, and equal windows are found by hash.

An anchor with very many different strings (a near-copy of one passage in millions of documents) is dealt out over
the places that an anchor can have within a window: windows that differ in it are never equal. No task needs a
whole group, and no pair is ever made. Texts are known by a 128-bit hash. Each row's text moves once, to meet the
list of its open segments and then its repeated windows: both joins read the same exchange.

Defined cases: null is the empty text; a text shorter than a window keeps all its bytes; equal texts of a window or
more lose everything, in every copy, as the rule asks; ids are never read, so null and repeated ones change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accountlens.llm.common import SPACES, as_bytes, in_slices, read_table, written

WINDOW = 400
GRAM = 40
#: The pipeline's depth in words, and the words of a gram.
WORDS = 50
WORD_GRAM = 5
#: Most strings under one anchor that are compared in one task.
UNIT = 4096
#: Window starts worked on at a time; also the reach of the tables of powers.
CHUNK = 1 << 18

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of the base and of its inverse, modulo 2 to the 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 4 * WINDOW)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
                      for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def rolling(raw: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, or of ``length`` hashes of words."""
    up, down = _powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_TABLE[raw] if raw.dtype == np.uint8 else raw) * up, out=total[1:])
    return (total[length:] - total[:-length]) * down[:len(raw) - length + 1]


def least_of_runs(values: np.ndarray, length: int) -> np.ndarray:
    """The least of each run of ``length`` values: the smaller of a block's rest and the next block's start."""
    n = len(values)
    blocks = np.full(-(-n // length) * length, values.max(), values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, length)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    rest = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rest[:n - length + 1], ahead[length - 1:n])


def as_words(text: bytes) -> np.ndarray:
    """A hash of each word."""
    return np.array([xxhash.xxh3_64_intdigest(w) for w in text.split()], np.uint64)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte behind it."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[np.frombuffer(text, np.uint8)]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def sparse_starts(text: bytes, window: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs [first, last] of the windows of bytes that hold fewer than ``words`` words with white space at both ends.

    The others hold a window of words, which finds them.
    """
    starts = len(text) - window + 1
    if starts < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, end = word_places(text)
    begun, ended = (np.bincount(x, minlength=len(text) + 1).cumsum() for x in (first, end))
    sparse = np.zeros(starts + 2, np.int8)
    sparse[1:-1] = ended[window - 1:window - 1 + starts] - begun[:starts] < words
    step = np.diff(sparse)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1


def within(part: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """The ``segments`` cut to the window starts in the runs [first, last]."""
    at, lo, hi, g = part
    a, b = np.searchsorted(last, lo), np.searchsorted(first, hi, side="right")
    n = np.maximum(b - a, 0)
    row = np.repeat(np.arange(len(at)), n)
    run = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + a[row]
    return [at[row], np.maximum(lo[row], first[run]), np.minimum(hi[row], last[run]), g[row]]


def segments(text: bytes | np.ndarray, window: int = WINDOW, gram: int = GRAM) -> list[np.ndarray]:
    """Anchor place, first and last window start, and the anchor's hash, for each segment of a text, in bytes or words."""
    raw = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text
    starts = len(raw) - window + 1
    place_bits = np.uint64(24)
    parts = []
    for begin in range(0, starts, CHUNK):
        chunk = raw[begin:min(begin + CHUNK, starts) + window - 1]
        hashes = rolling(chunk, gram) * _MIX
        hashes ^= hashes >> np.uint64(29)
        ranked = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=np.uint64)
        places = (least_of_runs(ranked, window - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        last = np.concatenate([first[1:], [len(places)]]) - 1
        parts.append([places[first] + begin, first + begin, last + begin, hashes[places[first]].view(np.int64)])
    if not parts:
        return [np.zeros(0, np.int64)] * 4
    at, lo, hi, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    # A segment cut by the end of a chunk goes on in the next.
    new = np.concatenate([[True], at[1:] != at[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return [at[first], lo[first], hi[last], hashes[first]]


def _segment_rows(texts: DataFrame, window: int, gram: int, by_words: bool = False, dense: int = 0) -> DataFrame:
    """One row for each segment of each row of ``texts`` (k1, k2, body); windows with ``dense`` words are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            found, strings, counts = [], [], []
            for text in batch.column(2).to_pylist():
                text = as_words(text) if by_words else text
                part = segments(text, window, gram)
                part = within(part, *sparse_starts(text, window, dense)) if dense else part
                found.append(part)
                counts.append(len(part[0]))
                strings += [xxhash.xxh3_64_intdigest(text[a:b + window]) for a, b in zip(part[1].tolist(), part[2].tolist(), strict=True)]
            if not strings:
                continue
            at, lo, hi, g = (np.concatenate(x) for x in zip(*found, strict=True))
            c = np.array(strings, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(k1, counts)), pa.array(np.repeat(k2, counts)),
                 *(pa.array(x.astype(np.int32)) for x in (at, lo, hi)), pa.array(g), pa.array(c)],
                names=["k1", "k2", "at", "lo", "hi", "g", "c"])

    return texts.mapInArrow(run, "k1 long, k2 long, at int, lo int, hi int, g long, c long")


@dataclass(frozen=True)
class Rule:
    """Which windows count: of so many bytes, or words; and how long their grams are. Windows of bytes with ``dense``
    words are left out."""

    window: int
    gram: int
    by_words: bool = False
    dense: int = 0

    @property
    def places(self) -> int:
        """The places that an anchor can have within a window."""
        return self.window - self.gram + 1


def _strings(texts: DataFrame, wanted: DataFrame, rules: list[Rule]) -> DataFrame:
    """The strings of the ``wanted`` segments of all rules, cut at the borders of their slices of anchor places.

    All columns of ``texts`` go through the join, so that its exchange is that of the join in ``cut_rows``. Of equal texts
    a task reads one. If tasks share them their strings come twice, which is right: all windows of such a text repeat.
    """
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("rule", "at", "lo", "hi", "g", "slices")).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in in_slices(batches, names.index("body")):
            rows = []
            for k1, k2, text, found in zip(*(batch.column(names.index(c)).to_pylist() for c in ("k1", "k2", "body", "list")), strict=True):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                words = as_words(text) if any(rules[s["rule"]].by_words for s in found) else None
                for s in found:
                    rule, at, n = rules[s["rule"]], s["at"], s["slices"]
                    body = words if rule.by_words else text
                    for part in range(n):
                        # Windows whose anchor stands at offsets first .. end - 1.
                        first, end = rule.places * part // n, rule.places * (part + 1) // n
                        lo, hi = max(s["lo"], at - end + 1), min(s["hi"], at - first)
                        if lo <= hi:
                            rows.append((s["rule"], s["g"], part, k1, k2, lo, bytes(body[lo:hi + rule.window])))
                if len(rows) > 5000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["rule", "g", "part", "k1", "k2", "lo", "body"])

    joined = texts.join(lists, ["k1", "k2"])
    names = joined.columns
    return joined.mapInArrow(
        run, "rule int, g long, part int, k1 long, k2 long, lo int, body binary")


def _by_rule(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The parts of a batch that belong to one rule; its first column has them in order."""
    rule = batch.column(0).to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(rule)) + 1).tolist(), len(rule)]
    for begin, end in zip(edges, edges[1:], strict=False):
        yield int(rule[begin]), batch.slice(begin, end - begin)


def _equal_windows(strings: DataFrame, rules: list[Rule]) -> DataFrame:
    """Runs (rule, k1, k2, lo, hi) of window starts in ``strings`` that share their window with another start."""
    def hashed(batch: pa.RecordBatch, rule: Rule) -> list[np.ndarray]:
        """g, part, k1, k2, start and hash of each window of a batch."""
        kind = np.dtype(np.uint64 if rule.by_words else np.uint8)
        *keys, lo = (batch.column(i).to_numpy() for i in range(1, 6))
        bodies = batch.column(6).to_pylist()
        out = []
        i = 0
        while i < len(bodies):
            j, size = i, 0
            while j < len(bodies) and (j == i or size + len(bodies[j]) <= CHUNK):
                size += len(bodies[j])
                j += 1
            lengths = np.array([len(b) for b in bodies[i:j]]) // kind.itemsize
            offsets, starts = np.cumsum(lengths) - lengths, lengths - rule.window + 1
            every = rolling(np.frombuffer(b"".join(bodies[i:j]), kind), rule.window)
            row = np.repeat(np.arange(j - i), starts)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
            out.append((row + i, lo[i:j][row] + inner, every[offsets[row] + inner]))
            i = j
        row, start, code = (np.concatenate(x) for x in zip(*out, strict=True))
        return [*(k[row] for k in keys), start, code]

    def solve(rule: int, held: list[list[np.ndarray]]) -> pa.RecordBatch:
        _, _, k1, k2, start, code = (np.concatenate(x) for x in zip(*held, strict=True))
        _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
        marked = counts[inverse] > 1
        k1, k2, start = k1[marked], k2[marked], start[marked]
        new = np.ones(len(start), bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(start)]]).astype(np.int64)[:len(first)] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(first), rule, np.int32)), pa.array(k1[first]), pa.array(k2[first]),
             pa.array(start[first].astype(np.int32)), pa.array(start[last].astype(np.int32))], names=["rule", "k1", "k2", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        now = -1
        # A byte of a string becomes some fifteen bytes of windows.
        for batch in in_slices(batches, limit=1_000_000):
            for rule, part in _by_rule(batch) if batch.num_rows else ():
                if rule != now and held:
                    yield solve(now, held)
                    held = []
                now = rule
                rows = hashed(part, rules[rule])
                # Windows of the last group wait for what comes next.
                cut = len(rows[0]) - int(np.count_nonzero((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])))
                goes_on = bool(held) and cut == 0 and held[-1][0][-1] == rows[0][-1] and held[-1][1][-1] == rows[1][-1]
                if not goes_on:
                    held.append([x[:cut] for x in rows])
                    if any(len(x[0]) for x in held):
                        yield solve(rule, held)
                    held = []
                held.append([x[cut:] for x in rows])
        if held:
            yield solve(now, held)

    return (strings.repartition("rule", "g", "part").sortWithinPartitions("rule", "g", "part")
            .mapInArrow(run, "rule int, k1 long, k2 long, lo int, hi int"))


def repeated_starts(texts: DataFrame, rules: list[Rule], unit: int = UNIT) -> DataFrame:
    """Runs (rule, k1, k2, lo, hi) of starts of windows that also start elsewhere, by each rule; equal texts bring theirs each.

    ``texts``: one row a document, with k1, k2, body. The starts of a rule by words count words.
    """
    equal, wanted = [], []
    for number, rule in enumerate(rules):
        rows = written(_segment_rows(texts.select("k1", "k2", "body"), rule.window, rule.gram, rule.by_words, rule.dense), "suffix-segments")
        # Second pass. ``one`` stands for all segments with its string.
        strings = rows.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at", "lo", "hi")).alias("one"))
        strings = written(strings, "suffix-strings")
        whole = strings.filter("n > 1").select("g", "c")
        equal.append(rows.join(whole, ["g", "c"]).select(F.lit(number).alias("rule"), "k1", "k2", "lo", "hi"))
        # Third pass, for anchors with a string that stands alone beside others.
        open_groups = (strings.groupBy("g").agg(F.count("*").alias("held"), F.count_if(F.col("n") == 1).alias("alone"))
                       .filter("held > 1 AND alone > 0")
                       .select("g", F.least(F.ceil(F.col("held") / unit), F.lit(rule.places)).cast("int").alias("slices")))
        wanted.append(strings.join(open_groups, "g").select(F.lit(number).alias("rule"), "one.*", "g", "slices"))
    strings = _strings(texts, reduce(DataFrame.unionByName, wanted), rules)
    return reduce(DataFrame.unionByName, [*equal, _equal_windows(strings, rules)])


def text_keys() -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(as_bytes()), F.xxhash64(F.lit(1), as_bytes())


def keyed(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, the key of the text, and its bytes."""
    k1, k2 = text_keys()
    return docs.select(*carry, k1.alias("k1"), k2.alias("k2"), as_bytes().alias("body"))


def one_each(texts: DataFrame) -> DataFrame:
    return texts.dropDuplicates(["k1", "k2"])


def _cut(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans [a, b), joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _grouped_runs(texts: DataFrame, rules: list[Rule], unit: int) -> DataFrame:
    """(k1, k2, runs) of the texts that hold repeated windows. Equal texts bring equal runs, each is kept once."""
    runs = repeated_starts(texts, rules, unit)
    return runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi", "rule")).alias("runs"))


_LEFT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _cut_texts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` ends with the columns body and runs; in their place come the counts, the digest and the text of what is left."""
    carried = df.columns[:-2]
    out = StructType([*df.select(*carried).schema, *StructType.fromDDL(_LEFT)])

    def spans_of(text: bytes, found: list[dict]) -> list[tuple[int, int]]:
        first, end = word_places(text) if any(rules[r["rule"]].by_words for r in found) else ([], [])
        return _cut([(int(first[r["lo"]]), int(end[r["hi"] + rules[r["rule"]].window - 1])) if rules[r["rule"]].by_words
                     else (r["lo"], min(r["hi"] + rules[r["rule"]].window, len(text))) for r in found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, len(carried)):
            rows = []
            for text, found in zip(batch.column(len(carried)).to_pylist(), batch.column(len(carried) + 1).to_pylist(), strict=True):
                spans = spans_of(text, found or [])
                edges = [0, *(x for s in spans for x in s), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(),
                             left.decode("utf-8", "ignore")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(carried)], *(pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True))], names=out.names)

    return df.mapInArrow(run, out)


def cut_rows(texts: DataFrame, rules: list[Rule], unit: int = UNIT) -> DataFrame:
    """The rows of ``texts`` (k1, k2, body, and others), with counts, digest and text of what is left in place of body.

    A text that very many rows hold is a skewed key with one row on the other side, which adaptive execution splits.
    """
    carried = [c for c in texts.columns if c != "body"]
    met = texts.join(_grouped_runs(texts, rules, unit), ["k1", "k2"], "left").select(*carried, "body", "runs")
    return _cut_texts(met, rules)


def cleaned(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, unit: int = UNIT, words: int = 0,
            word_gram: int = WORD_GRAM) -> DataFrame:
    """For each distinct text its key, counts, the digest of what is left, and what is left as a text.

    With ``words``, windows of so many words count, however few bytes they have and whatever white space parts them,
    and beside them the windows of bytes that hold fewer words than that.
    """
    return one_each(cut_rows(keyed(docs), _rules(window, gram, words, word_gram), unit))


def _rules(window: int = WINDOW, gram: int = GRAM, words: int = 0, word_gram: int = WORD_GRAM) -> list[Rule]:
    return [Rule(window, gram, dense=words), *([Rule(words, word_gram, by_words=True)] if words else [])]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated windows cut out of ``text``; bytes of a character that a cut parted go with it.

    This is the pipeline's rule: windows of 50 words, or of 400 bytes where those hold fewer words than that.

    Every row stays, with its own columns; ``n_chars``, where there is such a column, counts the new text. A null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    k1, k2 = text_keys()
    rows = docs.select(*(F.col(c).alias(f"__{i}") for i, c in enumerate(others)), F.col("text").isNull().alias("__null"),
                       k1.alias("k1"), k2.alias("k2"), as_bytes().alias("body"))
    left = cut_rows(rows, _rules(words=WORDS))
    text = F.when(~F.col("__null"), F.col("kept"))
    columns = {c: F.col(f"__{i}") for i, c in enumerate(others)} | {"text": text}
    if "n_chars" in others:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return left.select(*(columns[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` is what is left without the bytes of characters that a cut parted; the digest is of all bytes that are left."""
    docs = read_table(spark, sf_dir, "documents")
    return cut_rows(keyed(docs, "doc_id"), _rules()).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"))
