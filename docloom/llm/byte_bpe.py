"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

Every distinct word of a block of texts is folded once: from its single bytes on, the
adjacent pair of the lowest rank (the leftmost of equals) is merged until none is left,
all words of a length side by side.  Texts are then looked up word by word.  Decoding
concatenates the pieces of the ids.

A fold by Spark's own higher-order functions gives the same ids; see the README for
why it is not used.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, slices

#: Words whose ids a Python process remembers at a time; the first half, seen early and so often, stays.
MOST_KNOWN = 120_000
#: Bytes of text that are worked on at a time.
SLICE_BYTES = 1 << 20
#: Longer words are merged one by one with a heap, so that time stays near linear.
LONG_WORD = 64
_NONE = np.int64(1) << 40
_SLOTS, _GROUPS, _FACTOR = 1 << 18, 50_021, 2_654_435_761


def _spread(key: np.ndarray) -> np.ndarray:
    return (key * _FACTOR) >> 20


class MergeTable:
    """For two adjacent ids the id they merge to: a hash table without collisions, looked up by whole arrays."""

    def __init__(self, merges: dict[int, int]) -> None:
        keys = np.array(list(merges), np.int64)
        group = keys % _GROUPS
        order = np.argsort(group, kind="stable")
        parts = np.split(keys[order], np.flatnonzero(np.diff(group[order])) + 1)
        slots = max(_SLOTS, 1 << int(2 * len(keys)).bit_length())
        self.mask, self.entries = slots - 1, np.full(slots, -1, np.int64)
        self.shift = np.zeros(_GROUPS, np.int64)
        free = np.ones(slots, bool)
        for part in sorted(parts, key=len, reverse=True):  # large groups first, each moved until it fits
            at, shift = _spread(part), 0
            while not (len(np.unique(places := (at + shift) & self.mask)) == len(part) and free[places].all()):
                shift += 1
                if shift > slots:
                    raise ValueError("no collision-free table for these merges")
            free[places] = False
            self.shift[part[0] % _GROUPS] = shift
            self.entries[places] = part << 20 | np.array([merges[k] for k in part.tolist()])

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        entry = self.entries[(_spread(key) + self.shift[key % _GROUPS]) & self.mask]
        return np.where(entry >> 20 == key, entry & 0xFFFFF, _NONE)


class Vocabulary:
    """A rank file: the pattern that splits texts, pieces by id, ids by piece, and the merges."""

    def __init__(self, pattern: str, ids: dict[bytes, int]) -> None:
        self.pattern, self.ids = pattern, ids
        self.pieces = [b""] * (max(ids.values()) + 1)
        self.merges: dict[int, int] = {}
        for piece, rank in ids.items():
            self.pieces[rank] = piece
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    self.merges[left << 20 | right] = rank
        self.table = MergeTable(self.merges)
        self.bytes = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """Read ``path`` (lines of a base64 piece and its rank) on the driver; its size bounds what tasks get."""
        with open(path, "rb") as file:
            return cls(pattern, {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)})

    def learn(self, words: set[str]) -> None:
        """Fold all words that are not known yet."""
        if len(self.known) > MOST_KNOWN:
            self.known = dict(islice(self.known.items(), MOST_KNOWN // 2))
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            if word not in self.known:
                raw = word.encode("utf-8", "surrogatepass")
                whole = self.ids.get(raw)
                if whole is not None:
                    self.known[word] = whole.to_bytes(4, sys.byteorder)
                elif len(raw) > LONG_WORD:
                    self.known[word] = np.array(self.fold_long(raw), np.int32).tobytes()
                else:
                    by_length.setdefault(len(raw), []).append((word, raw))
        for length, group in by_length.items():
            raw = np.frombuffer(b"".join(r for _, r in group), np.uint8).reshape(-1, length)
            for row, ids in self.fold(self.bytes[raw]):
                self.known[group[row][0]] = ids

    def fold(self, parts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Fold the rows of a matrix of byte ids together, a merge a step; yields (row, its ids as int32)."""
        rows, ranks = np.arange(len(parts)), self.table(parts[:, :-1], parts[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            rank = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            over = rank == _NONE
            if over.any():
                done, width = parts[over].astype(np.int32).tobytes(), 4 * parts.shape[1]
                yield from ((r, done[i * width : (i + 1) * width]) for i, r in enumerate(rows[over].tolist()))
                rows, parts, ranks, at, rank = (x[~over] for x in (rows, parts, ranks, at, rank))
            if not len(rows):
                break
            each, columns = np.arange(len(rows)), np.arange(parts.shape[1] - 1)
            # Drop the second part of each merged pair, and the rank of the pair.
            parts[each, at] = rank
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < len(columns))
            ranks[left, at[left] - 1] = self.table(parts[left, at[left] - 1], rank[left])
            ranks[right, at[right]] = self.table(rank[right], parts[right, at[right] + 1])

    def fold_long(self, word: bytes) -> list[int]:
        """The ids of one word of any length."""
        parts = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        n = len(parts)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            following = after[at]
            if following >= 0:
                rank = self.merges.get(parts[at] << 20 | parts[following])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, parts[at], parts[following]))

        for at in range(n):
            offer(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            following = after[at]
            if parts[at] != left or following < 0 or parts[following] != right:
                continue  # a part of this pair has been merged meanwhile
            parts[at], parts[following] = rank, -1
            after[at] = after[following]
            if after[at] >= 0:
                before[after[at]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [p for p in parts if p >= 0]


def _encoded(own: Vocabulary, split: Callable[[str], list[str]], column: pa.Array) -> pa.ListArray:
    texts = [split(text or "") for text in column.to_pylist()]
    own.learn(set().union(*texts))
    rows = [b"".join(map(own.known.__getitem__, words)) for words in texts]
    sizes = [0, *(len(row) // 4 for row in rows)]
    ids = pa.array(np.frombuffer(b"".join(rows), np.int32))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), ids)


def _decoded(pieces: list[bytes], column: pa.ListArray) -> pa.Array:
    arrays = (x.values for x in column)
    piece = pieces.__getitem__
    found = [b"" if x is None else b"".join(map(piece, x.to_numpy(zero_copy_only=False).tolist())) for x in arrays]
    return pa.array(found, pa.binary())


def encode(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", output: str = "ids") -> DataFrame:
    """``docs`` with an array of token ids of the whole text in ``output``.

    Each match of the vocabulary's pattern is encoded by itself; there are no special
    tokens.  A null or empty text has no ids.  All rows and columns stay; a column named
    ``output`` is replaced.  Nothing is shuffled; a very long text is one row's work.
    """
    shared = Shared(docs.sparkSession, vocabulary)
    docs = docs.drop(output)
    schema = docs.withColumn(output, F.lit(None).cast("array<int>")).schema
    kinds = [f for f in schema.fieldNames() if f != output]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        split = regex.compile(own.pattern).findall
        for batch in slices(batches, text_column, SLICE_BYTES):
            ids = _encoded(own, split, batch.column(kinds.index(text_column)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*kinds, output])

    return docs.mapInArrow(scan, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids", output: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of ``ids_column`` in ``output``: the pieces of its ids, joined.

    Null or empty arrays give no bytes; an id outside the vocabulary is an error.  All
    rows and columns stay; a column named ``output`` is replaced.
    """
    shared = Shared(rows.sparkSession, vocabulary.pieces)
    rows = rows.drop(output)
    schema = rows.withColumn(output, F.lit(None).cast("binary")).schema
    kinds = [f for f in schema.fieldNames() if f != output]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.get()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                found = _decoded(pieces, some.column(kinds.index(ids_column)))
                yield pa.RecordBatch.from_arrays([*some.columns, found], [*kinds, output])

    return rows.mapInArrow(scan, schema)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one scan: ``ids`` and ``decoded`` instead of the text.

    The same two steps, with one Python process per core and one copy of the vocabulary.
    """
    shared = Shared(docs.sparkSession, vocabulary)
    docs = docs.drop("ids", "decoded")
    kept = [c for c in docs.columns if c != text_column]
    columns = docs.select(*kept).withColumn("ids", F.lit(None).cast("array<int>")).withColumn("decoded", F.lit(None).cast("binary"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        split = regex.compile(own.pattern).findall
        for batch in slices(batches, text_column, SLICE_BYTES):
            names = batch.schema.names
            ids = _encoded(own, split, batch.column(names.index(text_column)))
            others = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*others, ids, _decoded(own.pieces, ids)], [*kept, "ids", "decoded"])

    return docs.mapInArrow(scan, columns.schema)
