"""Byte-level BPE encoding and decoding with forced boundaries.

A merge can only join two tokens if the joined token is in the vocabulary, so a pair of
neighbouring bytes that occurs inside no vocabulary token is never joined: a cut there
is certain. A piece of text (as the vocabulary's own pattern splits it) is cut at all
such places; fragments are encoded independently and their ids concatenated. Fragments
are short, repeat a lot, and are remembered up to a bound; a long fragment without any
cut (one letter a million times) is merged with a heap in n log n.

The vocabulary file is read once on the driver and broadcast (about 1.5 MB, whatever the
corpus); texts stream through Arrow batches, one text at a time.

``ids`` is binary: token ids as little-endian unsigned 32-bit integers.

Edge cases: a null text is encoded as the empty text (no ids), decoded as the empty
text; a special token's string inside a text becomes that token, as the vocabulary's
library does by default; whole texts whatever their length. An empty table gives an
empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeledger.llm.common import by_place, col, others, small_batches

#: Fixed value: how byte-level vocabularies of this kind split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: bytes that byte-level vocabularies print as themselves; the others are
#: printed, in order, as the characters from 256 on.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Remembered pieces per generation and worker, and the longest piece (in characters)
#: remembered. Most pieces of a corpus come once: more than this holds memory, not hits.
REMEMBERED, LONGEST = 20_000, 40
#: Below this many bytes a fragment is merged by plain search for the best pair.
SHORT = 24
#: Rank of a pair that is never joined.
NEVER = 1 << 60
#: Fragments up to these many bytes are merged together; longer ones by themselves.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32)


def printed_bytes() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and certain cuts of one vocabulary file. What only encoding needs
    is built at its first use: a worker that decodes keeps the bytes of the tokens alone."""

    def __init__(self, text: str):
        self.text, byte_of = text, printed_bytes()
        spec = json.loads(text)
        self.id_of = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: s.encode() for s, i in self.special.items()}
        self.known = Remembered(self.piece_ids)
        self.both = Generations()
        self.pieces = regex.compile(PATTERN).findall
        names = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    @cached_property
    def single(self) -> list[int]:
        """Ids of the 256 bytes."""
        return [self.id_of[bytes((b,))] for b in range(256)]

    @cached_property
    def ranked(self) -> tuple[dict[int, int], list[int]]:
        """Two neighbouring ids, packed -> rank of their join; rank -> the joined id."""
        byte_of, joins, joined = printed_bytes(), {}, []
        for rank, pair in enumerate(json.loads(self.text)["model"]["merges"]):
            a, b = (bytes(byte_of[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            joins.setdefault(self.id_of[a] << 32 | self.id_of[b], rank)
            joined.append(self.id_of[a + b])
        return joins, joined

    @cached_property
    def certain(self) -> frozenset[int]:
        """Pairs of bytes (first * 256 + second) that lie inside no token."""
        inside = {token[i] * 256 + token[i + 1] for token in self.id_of for i in range(len(token) - 1)}
        return frozenset(range(1 << 16)) - inside

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece cut wherever a pair of bytes lies inside no token."""
        certain = self.certain
        cuts = [i for i in range(1, len(piece)) if piece[i - 1] * 256 + piece[i] in certain]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)])]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of one fragment: join the neighbours of lowest rank, leftmost first."""
        if len(fragment) > SHORT:
            return self._merge_long(fragment)
        single, (joins, joined) = self.single, self.ranked
        parts = [single[b] for b in fragment]
        ranks = [joins.get(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            parts[i:i + 2] = [joined[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = joins.get(parts[i - 1] << 32 | parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = joins.get(parts[i] << 32 | parts[i + 1], NEVER)
        return parts

    def _merge_long(self, fragment: bytes) -> list[int]:
        n, single, (joins, joined) = len(fragment), self.single, self.ranked
        parts = [single[b] for b in fragment]  # -1: joined into an earlier one
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        open_ = [(r, i) for i in range(n - 1) if (r := joins.get(parts[i] << 32 | parts[i + 1], NEVER)) != NEVER]
        heapify(open_)
        while open_:
            rank, i = heappop(open_)
            j = after[i]
            if parts[i] < 0 or j >= n or joins.get(parts[i] << 32 | parts[j], NEVER) != rank:
                continue  # one of the two has been joined since
            parts[i], parts[j] = joined[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := joins.get(parts[x] << 32 | parts[y], NEVER)) != NEVER:
                    heappush(open_, (r, x))
        return [p for p in parts if p >= 0]

    def piece_ids(self, piece: str) -> bytes:
        """Packed ids of a piece: of its fragments, one after the other."""
        ids = array("I", chain.from_iterable(map(self.merge, self.fragments(piece.encode()))))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def packed_bytes(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        ids = array("I", packed)
        if sys.byteorder == "big":
            ids.byteswap()
        return b"".join(map(self.bytes_of.__getitem__, ids))

    @cached_property
    def lookup(self) -> tuple[np.ndarray, ...]:
        """The merges as arrays: packed pairs in order, their ranks; rank -> joined id; byte ->
        id; pair of bytes -> whether it is a certain cut."""
        joins, joined = self.ranked
        pairs = np.fromiter(joins, np.int64, len(joins))
        order = np.argsort(pairs)
        cut = np.zeros(1 << 16, bool)
        cut[list(self.certain)] = True
        return pairs[order], np.fromiter(joins.values(), np.int64, len(joins))[order], np.array(joined, np.int64), np.array(self.single, np.int64), cut

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids (-1: no token, never joined)."""
        pairs, ranks, *_ = self.lookup
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        return np.where((pairs[at] == key) & (left >= 0) & (right >= 0), ranks[at], NEVER)

    def _merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """Ids of fragments, one a row (padded with -1): a round joins the leftmost pair of
        lowest rank in every row that has one."""
        out = np.full(parts.shape, -1, np.int64)
        at, ranks, joined = np.arange(len(parts)), self._ranks(parts[:, :-1], parts[:, 1:]), self.lookup[2]
        while True:
            best = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(parts), np.int64)
            least = np.take_along_axis(ranks, best[:, None], 1)[:, 0] if ranks.shape[1] else np.full(len(parts), NEVER)
            open_ = least != NEVER
            out[at[~open_], :parts.shape[1]] = parts[~open_]
            if not open_.any():
                return out
            at, parts, ranks, best, least = at[open_], parts[open_], ranks[open_], best[open_], least[open_]
            rows, places = np.arange(len(parts)), np.arange(parts.shape[1] - 1)
            parts[rows, best] = joined[least]
            parts = np.take_along_axis(parts, places + (places > best[:, None]), 1)
            ranks = np.take_along_axis(ranks, places[:-1] + (places[:-1] >= best[:, None]), 1)
            width = parts.shape[1]
            before, after = rows[best > 0], rows[best < width - 1]
            ranks[before, best[before] - 1] = self._ranks(parts[before, best[before] - 1], parts[before, best[before]])
            ranks[after, best[after]] = self._ranks(parts[after, best[after]], parts[after, best[after] + 1])

    def ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and where each piece's begin and end. Fragments
        are cut for all pieces at once and merged together by length."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        *_, single, cut = self.lookup
        raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        ends = np.cumsum([len(p) for p in pieces])
        first = np.zeros(len(raw) + 1, bool)
        first[1:-1] = cut[raw[:-1] * 256 + raw[1:]]
        first[np.r_[0, ends[:-1]]] = True
        start = np.flatnonzero(first[:-1])
        size = np.diff(np.r_[start, len(raw)])
        merged, count = [None] * (len(WIDTHS) + 1), np.ones(len(start), np.int64)
        for k, (low, high) in enumerate(zip((0, *WIDTHS), WIDTHS)):
            own = np.flatnonzero((size > low) & (size <= high))
            spread = np.arange(high)
            inside = spread < size[own][:, None]
            ids = single[raw[np.minimum(start[own][:, None] + spread, len(raw) - 1)]]
            rows = self._merge_rows(np.where(inside, ids, -1))
            merged[k] = (own, rows)
            count[own] = (rows >= 0).sum(1)
        long = np.flatnonzero(size > WIDTHS[-1])
        made = [self.merge(raw[start[i]:start[i] + size[i]].astype(np.uint8).tobytes()) for i in long]
        count[long] = [len(m) for m in made]
        to = np.r_[0, np.cumsum(count)]
        flat = np.empty(to[-1], np.int64)
        for own, rows in merged[:-1]:
            held = rows >= 0
            flat[(to[own][:, None] + np.cumsum(held, 1) - 1)[held]] = rows[held]
        for i, m in zip(long, made):
            flat[to[i]:to[i + 1]] = m
        return flat, np.r_[0, to[np.searchsorted(start, ends)]]

    def both_of(self, pieces: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of each piece, and the bytes that these decode to."""
        flat, at = self.ids_of([p.encode() for p in pieces])
        packed, ids, of, at = flat.astype("<u4").tobytes(), flat.tolist(), self.bytes_of.__getitem__, at.tolist()
        return [packed[4 * a:4 * b] for a, b in zip(at, at[1:])], [b"".join(map(of, ids[a:b])) for a, b in zip(at, at[1:])]

    def encode_decode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Packed ids of each text and the text they decode to. Decoded bytes are those of the
        ids, one after the other, so a piece's ids are looked up and joined once; the pieces
        not remembered are made together."""
        special = self.special
        parts = [self.split_special.split(t) if self.split_special else [t] for t in texts]
        cut = [[None if p in special else self.pieces(p) for p in own] for own in parts]
        wanted = set(chain.from_iterable(pieces for own in cut for pieces in own if pieces))
        ids_of, shown_of = (table.__getitem__ for table in self.both.holding(wanted, self.both_of))
        out = []
        for own, found in zip(parts, cut):
            packed, decoded = [], []
            for part, pieces in zip(own, found):
                if pieces is None:
                    ids = special[part].to_bytes(4, "little")
                    packed.append(ids), decoded.append(self.packed_bytes(ids))
                elif pieces:
                    packed += map(ids_of, pieces)
                    decoded += map(shown_of, pieces)
            out.append((b"".join(packed), b"".join(decoded).decode("utf-8", errors="replace")))
        return out

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        packed, of = [], self.known.__getitem__
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                packed.append(self.special[part].to_bytes(4, "little"))
            else:
                packed.append(b"".join(map(of, self.pieces(part))))
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        return self.packed_bytes(packed).decode("utf-8", errors="replace")


class Remembered(dict):
    """piece -> packed ids, computed when missing. Two generations: when the young one is
    full it becomes the old one, and what is used again moves over."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, piece: str):
        made = self.old.get(piece)
        if made is None:
            made = self.compute(piece)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = made
        return made


class Generations:
    """What was made of pieces (ids, decoded bytes), as two generations: the young one becomes
    the old one when it is full, and what is used again moves over."""

    def __init__(self):
        self.young, self.old = ({}, {}), ({}, {})

    def holding(self, wanted: set[str], make) -> tuple[dict, dict]:
        """Two tables that hold ``wanted``; ``make`` gives what is missing, all at once."""
        if len(self.young[0]) >= REMEMBERED:
            self.young, self.old = ({}, {}), self.young
        missing = wanted - self.young[0].keys()
        back = missing & self.old[0].keys()
        made = list(missing - back)
        tables = []
        for young, old, new in zip(self.young, self.old, make(made)):
            fresh = {p: old[p] for p in back} | dict(zip(made, new))
            young.update((p, x) for p, x in fresh.items() if len(p) <= LONGEST)
            tables.append(young if all(len(p) <= LONGEST for p in made) else young | fresh)
        return tuple(tables)


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    """Parsed once per Python worker."""
    return Vocabulary(text)


def load(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, shipped to the executors (they needn't see the path)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _mapped(df: DataFrame, source: str, out: str, kind: T.DataType, each) -> DataFrame:
    """``df`` without ``source`` and with ``out`` = each(value of source)."""
    keep = [c for c in others(df, (out,)) if c != source]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = each()
        for batch in small_batches(batches):
            values = batch.column(batch.num_columns - 1)
            made = pa.array((do(v.as_py()) for v in values), type=arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*keep, out])

    return by_place(df.select(*[col(c) for c in keep], col(source))).mapInArrow(run, schema)


def encode_decode(df: DataFrame, vocab: Broadcast, *, text: str = "text", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``text`` replaced by ``ids`` and the text they decode to, in one pass."""
    keep = [c for c in others(df, ("ids", decoded)) if c != text]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("ids", T.BinaryType()), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = vocabulary(vocab.value).encode_decode_all
        for batch in small_batches(batches):
            made = do([v or "" for v in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.string())],
                names=[*keep, "ids", decoded])

    return by_place(df.select(*[col(c) for c in keep], col(text))).mapInArrow(run, schema)


def encode(df: DataFrame, vocab: Broadcast, *, text: str = "text") -> DataFrame:
    """``df`` with ``text`` replaced by ``ids``."""

    def each():
        v = vocabulary(vocab.value)
        return lambda s: v.encode(s) if s else b""

    return _mapped(df, text, "ids", T.BinaryType(), each)


def decode(df: DataFrame, vocab: Broadcast, *, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` replaced by the decoded ``text``."""

    def each():
        v = vocabulary(vocab.value)
        return lambda packed: v.decode(packed or b"")

    return _mapped(df, "ids", text, T.StringType(), each)
