"""SentencePiece encoding that keeps offsets, and decoding.

The model file is read here (pieces, scores, normaliser); nothing is trained and no library encodes. A text is
normalised by its longest prefix in the compiled character map (a double-array trie over UTF-8 bytes), again and
again; for each byte put out, the place in the source that it came from is recorded. Byte pair merges then give the
pieces, and the record projects each piece's end back to a byte of the source: the spans of a text's pieces follow one
another and cover it.

Merges never cross a place that no piece crosses, so a text falls into short segments (mostly words) that can be
encoded alone. New segments of a batch are merged side by side in numpy, one merge of each per round; the
results are kept in a table of at most ``KEEP`` segments per Python worker, which is emptied when it is full and at the end
of a partition. Long segments take a heap instead. The model's bytes (some hundred kB) are sent to the executors; nothing else is shared.

Supported are byte pair models with byte fallback and without user-defined or unused pieces; others are refused.
Defined cases: a null text is the empty text and has only the end id; very long texts and words are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import string
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from accountlens.llm.common import map_texts, read_table

SPACE = "▁"
#: Segments that a worker remembers, and the longest that is merged in the arrays.
KEEP = 200_000
LONG = 32

_NONE = np.iinfo(np.int32).max


class CharacterMap:
    """Longest-prefix replacement by a compiled map: the size of a trie, the trie, and its replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, np.uint32, size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size:] if size else b""

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest prefix of ``text[at:]`` in the map, and the prefix's length."""
        if not self.units:
            return None
        node, found, length = self._child(self.units[0]), -1, 0
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found, length = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if found < 0:
            return None
        return self.replacements[found:self.replacements.index(b"\0", found)], length


class Normalizer:
    def __init__(self, blob: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.map = CharacterMap(blob)
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.space = SPACE.encode() if escape else b" "

    def _prefixes(self, text: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Replacement, place and length of one prefix after the other."""
        at = 0
        while at < len(text):
            found = self.map.longest(text, at)
            if found is None:
                lead = text[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                char = text[at:at + size]
                try:
                    char.decode()
                    found = char, size
                except UnicodeDecodeError:
                    found = "�".encode(), 1
            yield found[0], at, found[1]
            at += found[1]

    def run(self, text: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each byte of it, and its end, the place in the source."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            return self._plain(text)
        out, places, after_space, end = [], [], self.squeeze, len(text)
        if self.squeeze:
            # Leading spaces belong to nothing.
            lead = next((at for new, at, _ in self._prefixes(text) if new != b" "), len(text))
            if lead == len(text):
                return "", np.full(1, len(text))
        else:
            lead = 0
        if self.dummy_prefix:
            out.append(self.space)
            places.append(lead)
        for new, at, size in self._prefixes(text[lead:]):
            if after_space:
                new = new.lstrip(b" ")
            if new:
                after_space = self.squeeze and new.endswith(b" ")
                for byte in new:
                    out.append(self.space if byte == 32 else bytes([byte]))
                    places.append(lead + at)
            end = lead + at + size
        normal, of = b"".join(out), np.append(np.repeat(np.array(places, np.int64), [len(x) for x in out]), end)
        while self.squeeze and normal.endswith(self.space):
            normal = normal[:-len(self.space)]
            of = of[:len(normal) + 1]
        return normal.decode(), of

    def _plain(self, text: bytes) -> tuple[str, np.ndarray]:
        """Without a map only spaces change."""
        raw = np.frombuffer(text, np.uint8)
        places = np.repeat(np.arange(len(raw) + 1), np.append(np.where(raw == 32, len(self.space), 1), 1))
        normal = text.decode("utf-8", "strict")
        space = self.space.decode()
        normal = normal.replace(" ", space) if space != " " else normal
        if self.dummy_prefix:
            return space + normal, np.concatenate([np.zeros(len(self.space), np.int64), places])
        return normal, places


class Encoder:
    """A model file's bytes, made ready to encode and decode."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        read = proto.ModelProto()
        read.ParseFromString(model)
        spec, kinds = read.normalizer_spec, read.SentencePiece.Type
        if read.trainer_spec.model_type != proto.TrainerSpec.BPE or not read.trainer_spec.byte_fallback:
            raise ValueError("only byte pair models with byte fallback are supported")
        if {p.type for p in read.pieces} - {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                     spec.escape_whitespaces)
        self.size = len(read.pieces)
        self.end = next(i for i, p in enumerate(read.pieces) if p.piece == (read.trainer_spec.eos_piece or "</s>"))
        self.unknown = {i for i, p in enumerate(read.pieces) if p.type == kinds.UNKNOWN}
        self.unknown_surface = (read.trainer_spec.unk_surface or " ⁇ ").encode()
        self.control = {i for i, p in enumerate(read.pieces) if p.type == kinds.CONTROL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(read.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        normal = {p.piece: i for i, p in enumerate(read.pieces) if p.type == kinds.NORMAL}
        self.surface = [self.byte_of.get(i, p.piece.encode()) for i, p in enumerate(read.pieces)]
        self.names = [str(i).encode() for i in range(self.size)]
        # Symbols: pieces, and after them every character that is no piece.
        self.symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.base = self.size + 0x110000
        order = {s: k for k, s in enumerate(sorted({read.pieces[i].score for i in normal.values()}, reverse=True))}
        merges = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = (normal.get(x, int(self.symbol[ord(x)]) if len(x) == 1 else None) for x in (piece[:cut], piece[cut:]))
                if a is not None and b is not None:
                    merges[a * self.base + b] = (order[read.pieces[i].score], i)
        keys = sorted(merges)
        self.keys = np.array([*keys, np.iinfo(np.int64).max])
        self.ranks = np.array([*(merges[k][0] for k in keys), _NONE], np.int64)
        self.merged = np.array([*(merges[k][1] for k in keys), -1], np.int64)
        self.merges = merges
        self.joined = {x + y for p in normal for x, y in itertools.pairwise(p)}
        self.cutter = self._cutter(list(normal))
        self.known: dict[str, tuple[bytes, bytes, bytes | None]] = {}

    def _cutter(self, pieces: list[str]) -> re.Pattern:
        """Cuts a text where no piece can cross: before a run of spaces, around line ends, between a letter and a mark."""
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            return re.compile(r"(?s).+")
        alone = re.escape("".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in pieces)))
        after_letter = {b for a, b in self.joined if a.isalpha()}
        marks = re.escape("".join(c for c in string.punctuation if c not in after_letter))
        parts = [f"{SPACE}*[^{SPACE}{alone}{marks}]*[^\\W\\d_](?=[{marks}])"] if marks else []
        parts += [f"{SPACE}*[^{SPACE}{alone}]+", f"{SPACE}+", *([f"[{alone}]"] if alone else [])]
        return re.compile("|".join(parts))

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((a >= 0) & (b >= 0), a * self.base + b, -1)
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.merged[at], -1)

    def _merge_arrays(self, words: Sequence[str]) -> Iterator[tuple[int, list[int]]]:
        """(place in ``words``, symbols), one merge of every word a round: the best rank, the leftmost of equals."""
        lengths = np.array([len(w) for w in words])
        flat = self.symbol[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        width = int(lengths.max())
        grid = np.full((len(words), width + 1), -1, np.int64)
        grid[np.arange(width + 1)[None, :] < lengths[:, None]] = flat
        rank, into = self._lookup(grid[:, :-1], grid[:, 1:])
        which = np.arange(len(words))
        columns = np.arange(width)
        while len(which):
            best = rank.argmin(1)
            rows = np.arange(len(which))
            more = rank[rows, best] < _NONE
            for r in np.flatnonzero(~more).tolist():
                yield int(which[r]), [s for s in grid[r].tolist() if s >= 0]
            which, grid, rank, into, best = (x[more] for x in (which, grid, rank, into, best))
            if not len(which):
                return
            rows = np.arange(len(which))
            shift = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), width)
            new = into[rows, best]
            grid[:, :-1] = np.take_along_axis(grid, shift, 1)
            grid[rows, best] = new
            # The pair at ``best`` is gone; those beside it are looked up again.
            after = np.minimum(columns[None, :] + (columns[None, :] >= best[:, None]), width - 1)
            last = columns[None, :] + (columns[None, :] >= best[:, None]) > width - 1
            rank = np.where(last, _NONE, np.take_along_axis(rank, after, 1))
            into = np.take_along_axis(into, after, 1)
            rank[rows, best], into[rows, best] = self._lookup(grid[rows, best], grid[rows, best + 1])
            left = np.flatnonzero(best > 0)
            at = best[left] - 1
            rank[left, at], into[left, at] = self._lookup(grid[left, at], grid[left, at + 1])

    def _merge_heap(self, word: str) -> list[int]:
        """Symbols of a long segment."""
        out: list[int] = []
        chars = self.symbol[np.frombuffer(word.encode("utf-32-le"), np.uint32)].tolist()
        edges = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.joined), len(word)]
        for begin, end in itertools.pairwise(edges):
            s = chars[begin:end]
            before, after = list(range(-1, len(s) - 1)), [*range(1, len(s)), -1]
            heap: list[tuple[int, int, int, int, int]] = []

            def offer(i: int, s=s, after=after, heap=heap) -> None:
                j = after[i] if i >= 0 else -1
                if j >= 0 and (m := self.merges.get(s[i] * self.base + s[j])):
                    heapq.heappush(heap, (m[0], i, s[i], s[j], m[1]))

            for i in range(len(s)):
                offer(i)
            while heap:
                _, i, a, b, new = heapq.heappop(heap)
                j = after[i]
                if s[i] != a or j < 0 or s[j] != b:
                    continue
                s[i], s[j] = new, -1
                after[i] = after[j]
                if after[j] >= 0:
                    before[after[j]] = i
                offer(before[i])
                offer(i)
            out += [x for x in s if x >= 0]
        return out

    def ids_of(self, symbols: list[int]) -> list[int]:
        """Ids of symbols; a character that is no piece becomes its bytes."""
        return [i for s in symbols for i in ([s] if s < self.size else [self.byte_ids[b] for b in chr(s - self.size).encode()])]

    def learn(self, words: Sequence[str]) -> None:
        """Put new segments into the table: ids as text, pieces' lengths in bytes, and what they decode to."""
        if len(self.known) + len(words) > KEEP:
            self.known.clear()

        def put(word: str, symbols: list[int]) -> None:
            ids = self.ids_of(symbols)
            surfaces = [self.surface[i] for i in ids]
            joined = b"".join(surfaces)
            # The pieces of a segment spell it out; only if not, their bytes are kept.
            self.known[word] = (b" ".join([self.names[i] for i in ids]), bytes([len(x) for x in surfaces]),
                                None if joined == word.encode() else joined)

        by_width: dict[int, list[str]] = {}
        for w in words:
            if len(w) > LONG:
                put(w, self._merge_heap(w))
            else:
                by_width.setdefault(-(-len(w) // 8), []).append(w)
        for group in by_width.values():
            for i in range(0, len(group), 20_000):
                part = group[i:i + 20_000]
                for at, symbols in self._merge_arrays(part):
                    put(part[at], symbols)

    def encode_batch(self, texts: Sequence[bytes]) -> Iterator[tuple[bytes, np.ndarray, bytes]]:
        """For each text: its ids as text without the end id, the source spans' ends, and the pieces' bytes in a row."""
        begin = 0
        while begin < len(texts):
            # About 2 MB of text at a time.
            stop, size = begin, 0
            while stop < len(texts) and (stop == begin or size + len(texts[stop]) < 2_000_000):
                size += len(texts[stop])
                stop += 1
            normal = [self.normalizer.run(t) for t in texts[begin:stop]]
            cut = [self.cutter.findall(t) for t, _ in normal]
            need = set(itertools.chain.from_iterable(cut))
            new = [w for w in need if w not in self.known]
            if len(self.known) + len(new) > KEEP:
                self.known.clear()
                new = list(need)
            if new:
                self.learn(new)
            for words, (_, places) in zip(cut, normal, strict=True):
                found = [self.known[w] for w in words]
                lengths = np.frombuffer(b"".join([f[1] for f in found]), np.uint8)
                spelt = "".join(words).encode() if all(f[2] is None for f in found) else b"".join(
                    [w.encode() if f[2] is None else f[2] for w, f in zip(words, found, strict=True)])
                yield b" ".join([f[0] for f in found]), places[np.cumsum(lengths, dtype=np.int64)], spelt
            begin = stop

    def encode(self, text: str) -> list[tuple[int, int, int]]:
        """Ids with the byte spans of the source that they stand for, without an end id."""
        ids, ends, _ = next(self.encode_batch([text.encode()]))
        ends = ends.tolist()
        return list(zip(map(int, ids.split()), [0, *ends], ends, strict=False))

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_bytes([(i, self.unknown_surface if i in self.unknown else b"" if i in self.control else self.surface[i])
                                  for i in ids])

    def decode_bytes(self, pieces: Sequence[tuple[int, bytes]]) -> str:
        out, space, first = [], SPACE.encode(), True
        for kind, group in itertools.groupby(pieces, lambda p: "control" if p[0] in self.control else "byte" if p[0] in self.byte_of else "text"):
            body = b"".join([x for _, x in group])
            if kind == "control":
                continue
            if kind == "byte":
                out.append(utf8_or_marks(body))
            else:
                if first and self.normalizer.dummy_prefix:
                    body = body.removeprefix(space)
                out.append(body.replace(space, b" ").decode())
            first = False
        return "".join(out)

    def plain_text(self, joined: bytes) -> bytes:
        """What the pieces of a whole text decode to, from their bytes in a row."""
        space = SPACE.encode()
        body = joined.removeprefix(space) if self.normalizer.dummy_prefix else joined
        return body.replace(space, b" ")


def utf8_or_marks(body: bytes) -> str:
    """Bytes as text; each byte that belongs to no character becomes a replacement mark."""
    out, at = [], 0
    while at < len(body):
        lead = body[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(body[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    """One encoder for each model and Python worker."""
    return Encoder(model)


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, carry: list[str], with_spans: bool = True) -> DataFrame:
    """``carry`` columns with ``ids`` (the end id last), ``ends`` (the byte of the source where each id ends) and ``decoded``."""
    def work(texts):
        e = encoder(model)
        ids, ends, decoded = [], [], []
        for text, (names, places, joined) in zip(texts, e.encode_batch(texts), strict=True):
            ids.append(np.array([*names.split(), e.end], np.int32))
            ends.append(np.append(places, len(text)).astype(np.int32) if with_spans else None)
            decoded.append(e.plain_text(joined).decode())
        return ids, ends, decoded

    return map_texts(docs, carry, work, "ids array<int>, ends array<int>, decoded string", done=lambda: encoder(model).known.clear())


def digest_documents(docs: DataFrame, model: bytes, carry: list[str]) -> DataFrame:
    """``carry`` columns, the number of ids (the end id included), and digests of the ids, the decoded text and the spans."""
    def work(texts):
        e = encoder(model)
        end = str(e.end).encode()
        counts, ids, decoded, spans = [], [], [], []
        for names, places, joined in e.encode_batch(texts):
            counts.append(len(places) + 1)
            ids.append(hashlib.sha256(names + b" " + end if names else end).hexdigest())
            decoded.append(hashlib.sha256(e.plain_text(joined)).hexdigest())
            spans.append(hashlib.sha256(places.astype("<i8").tobytes()).hexdigest())
        return counts, ids, decoded, spans

    return map_texts(docs, carry, work, "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string",
                     done=lambda: encoder(model).known.clear())


def default_model() -> bytes:
    import public_tokenizers

    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(read_table(spark, sf_dir, "documents"), default_model(), ["doc_id"])
