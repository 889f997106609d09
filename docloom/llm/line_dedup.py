"""Line deduplication by a segment-partition edit join.

A line is cut into t + 1 segments.  If another line is within t edits, one segment of the
shorter line stands unchanged in the longer one, near its own place; only the few
places that can matter, given both lengths, are probed.  Lines that meet under a segment
are pruned by a signature and verified with a banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import components, slices
from docloom.session import materialize

#: What ``\s`` matches, and what else may stand behind ``$``.
_SPACE, _LINE_ENDS = " \t\n\x0b\f\r", "\x85\u2028\u2029"
MAX_EDITS = 2
#: An edit is allowed for each so many characters of the shorter line, up to MAX_EDITS: a tenth of it.
CHARS_PER_EDIT = 10
#: An edit replaces at most two bigrams by two, and a bigram flips one bit of the signature.
MAX_FLIPS = 4 * MAX_EDITS
#: Rows of one key that are compared in one task; denser keys are split by equal parts of the signature.
DENSE = 1 << 14
#: Ids that are broadcast at most (16 bytes each); more are joined.
MOST_BROADCAST = 1 << 20
#: Bytes of lines that get their keys at a time.
_SLICE = 1 << 18
#: Pairs that are compared at a time.
_PAIRS = 1 << 21


def allowed(length: int) -> int:
    """Edits within which a line links to lines of its length or longer ones; none below ten characters."""
    return min(MAX_EDITS, length // CHARS_PER_EDIT)


def segments(length: int, edits: int = MAX_EDITS) -> list[tuple[int, int]]:
    """(begin, end) of the edits + 1 segments of a line; the longer ones come last."""
    parts = edits + 1
    short, longer = divmod(length, parts)
    cuts = [i * short + max(0, i - (parts - longer)) for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def probes(length: int) -> Iterator[tuple[int, int, int, int]]:
    """(shorter length, segment, begin, end) of all substrings of a line to look up in the index.

    With i segments before it, a segment that is the first unchanged one has moved by at
    most i; seen from the end, with the segments after it, by at most as many around the
    difference of the lengths.  The shorter line's length says how many edits there may be.
    """
    for other in range(max(0, length - MAX_EDITS), length + 1):
        gap, edits = length - other, allowed(other)
        if not edits or gap > edits:
            continue
        for i, (begin, end) in enumerate(segments(other, edits)):
            after = edits - i
            low = max(begin - i, begin + gap - after, 0)
            high = min(begin + i, begin + gap + after, length - (end - begin))
            for place in range(low, high + 1):
                yield other, i, place, place + end - begin


@lru_cache(maxsize=4096)
def _places(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a line of this length: (salt, begin, end, is it looked up and not indexed?)."""
    edits = allowed(length)
    own = [(length, i, b, e) for i, (b, e) in enumerate(segments(length, edits))] if edits else []
    # An indexed row meets the other indexed ones; it need not look up its own keys.
    asked = [p for p in probes(length) if p not in set(own)]
    n, i, begin, end = np.array([*own, *asked], np.int64).reshape(-1, 4).T
    return (n << 4 | i).astype(np.uint64), begin, end, np.arange(len(n)) >= len(own)


def signatures(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 parities of the bigrams of each line, as signed longs; ``sizes`` are the code points of each."""
    wide, signs = codes.astype(np.uint64), np.zeros(len(sizes), np.int64)
    ends, some = np.cumsum(sizes), sizes > 0
    flips = np.zeros(len(codes), np.uint64)
    if len(codes) > 1:
        mixed = (wide[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (wide[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(58)
        flips[:-1] = np.uint64(1) << (mixed ^ np.uint64(63))
    flips[ends[some] - 1] = 0  # the last sign of a line begins no bigram
    if some.any():
        signs[some] = np.bitwise_xor.reduceat(flips, (ends - sizes)[some]).view(np.int64)
    return signs


def within(a: str, b: str, edits: int = MAX_EDITS) -> bool:
    """Is the edit distance at most ``edits``?  Bit d of a state is a diagonal of the band."""
    if abs(len(a) - len(b)) > edits:
        return False
    start, stop = 0, min(len(a), len(b))
    while start < stop:  # skip what both begin with, by halves
        middle = (start + stop + 1) // 2
        if a[start:middle] == b[start:middle]:
            start = middle
        else:
            stop = middle - 1
    a, b = a[start:], b[start:]
    where: dict[str, int] = {}
    for i, sign in enumerate(a):
        where[sign] = where.get(sign, 0) | 1 << i + edits
    band = (1 << 2 * edits + 1) - 1
    # State e holds the diagonals (place in a - place in b + edits) reached with e edits.
    states = [(1 << edits) * ((1 << e + 1) - 1) & band for e in range(edits + 1)]
    for j, sign in enumerate(b):
        same = where.get(sign, 0) >> j & band
        inside = (1 << max(0, min(2 * edits + 1, len(a) - j + edits))) - 1  # diagonals where a has a sign left
        before, states[0] = states[0], states[0] & same
        for e in range(1, edits + 1):
            kept = states[e] & same | before & inside | before >> 1 | states[e - 1] << 1
            before, states[e] = states[e], kept & band
        if not states[edits]:
            return False
    return bool(states[edits] >> (len(a) - len(b) + edits) & 1)


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line_id, line) -> rows key, probe, line_id, sign; all keys of a slice at once.

    A key is a hash of a substring (a polynomial modulo 2**64, from prefix sums over the
    whole slice), of the length of the shorter line and of the segment's number.  Lines
    that meet by chance fall to the later checks.
    """
    for batch in slices(batches, "line", _SLICE):
        lines = batch.column(1).to_pylist()
        sizes = np.array([len(x) for x in lines], np.int64)
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        signs = signatures(codes, sizes)
        lengths, which = np.unique(sizes, return_inverse=True)
        places = [_places(n) for n in lengths.tolist()]
        salt, begin, end, probe = (np.concatenate(c) for c in zip(*places, strict=True))
        counts = np.array([len(p[0]) for p in places], np.int64)
        # Row i of the output is a key of line row[i], the one at at[i] among those of all lengths.
        each = counts[which]
        if not each.sum():
            continue
        row = np.repeat(np.arange(len(lines)), each)
        at = np.arange(len(row)) + np.repeat((np.cumsum(counts) - counts)[which] - (np.cumsum(each) - each), each)
        size = max(len(codes), _SLICE) + 1
        power, inverse = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], dtype=np.uint64, out=sums[1:])
        start = (np.cumsum(sizes) - sizes)[row]
        first = start + begin[at]
        hashed = (sums[start + end[at]] - sums[first]) * inverse[first]
        hashed = (hashed + salt[at] * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
        hashed = (hashed ^ hashed >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        columns = [hashed.view(np.int64), probe[at].astype(np.int64), ids[row], signs[row]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["key", "probe", "line_id", "sign"])


def _pairs(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of whole groups; rows key, not indexed, line_id, sign are sorted by the first two."""
    group = np.cumsum(np.diff(rows[:, 0], prepend=rows[:1, 0] - 1) != 0) - 1
    first = np.searchsorted(group, np.arange(group[-1] + 1))
    listed = rows[:, 1] == 0
    n_listed = np.bincount(group, listed)[group].astype(np.int64)
    # Each row meets the indexed rows before it: an indexed one those above, another one all.
    partners = np.where(listed, np.arange(len(rows)) - first[group], n_listed)
    signs = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
    ends, start = np.cumsum(partners), 0
    while start < len(rows):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _PAIRS, side="right")))
        counts = partners[start:stop]
        right = np.repeat(np.arange(start, stop), counts)
        left = np.arange(len(right)) - np.repeat(np.cumsum(counts) - counts, counts) + first[group[right]]
        near = np.bitwise_count(signs[left] ^ signs[right]) <= MAX_FLIPS
        a, b = rows[left[near], 2], rows[right[near], 2]
        yield np.minimum(a, b), np.maximum(a, b)
        start = stop


def _match(most: int | None) -> object:
    """Rows sorted by key -> candidate pairs, and the rows of keys denser than ``most``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray, rows: np.ndarray | None = None) -> pa.RecordBatch:
            more = np.zeros((0, 4), np.int64) if rows is None else rows
            zero, pad = np.zeros(len(more), np.int64), np.zeros(len(a), np.int64)
            columns = [np.concatenate([a, zero]), np.concatenate([b, zero]), *(np.concatenate([pad, more[:, i]]) for i in range(4))]
            dense = np.concatenate([np.zeros(len(a), bool), np.ones(len(more), bool)])
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(dense)], ["a", "b", "key", "probe", "line_id", "sign", "dense"])

        def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            same = rows[1:, 0] == rows[:-1, 0]
            rows = rows[np.append(same, False) | np.append(False, same)]  # a key of one row has no pairs
            if not len(rows):
                return
            for a, b in _pairs(rows[np.lexsort((rows[:, 1], rows[:, 0]))]):
                found = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
                if len(found):
                    yield out(found[:, 0], found[:, 1])

        none = np.zeros(0, np.int64)
        held, dense_key = np.zeros((0, 4), np.int64), None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if dense_key is not None:
                stop = int(np.searchsorted(rows[:, 0] != dense_key, True)) if (rows[:, 0] != dense_key).any() else len(rows)
                if stop:
                    yield out(none, none, rows[:stop])
                rows = rows[stop:]
                if not len(rows):
                    continue
                dense_key = None
            held = np.concatenate([held, rows])
            cut = int(np.searchsorted(held[:, 0], held[-1, 0]))
            if cut:
                yield from done(held[:cut])
                held = held[cut:]
            if most is not None and len(held) > most:
                yield out(none, none, held)
                dense_key, held = held[-1, 0], held[:0]
        if len(held):
            yield from done(held)

    return scan


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "line_a", 1 << 22):
        lines = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        near = [within(x, y, allowed(min(len(x), len(y)))) for x, y in lines]
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def line_links(lines: DataFrame) -> DataFrame:
    """All pairs a < b of different lines within the ``allowed`` edits of the shorter one (runs jobs).

    ``lines`` has one row per distinct line: line_id, line.  Two edits are allowed from 20
    code points on, one from 10 on; a shorter line is only equal to itself.  No candidate is capped: a key under which more than
    ``DENSE`` lines meet is split by the nine parts of the signature, of which two
    lines within reach share one.
    """
    long_lines = lines.where(F.char_length("line") >= CHARS_PER_EDIT).select("line_id", "line")
    rows = long_lines.mapInArrow(_keys, "key long, probe long, line_id long, sign long")
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "a long, b long, key long, probe long, line_id long, sign long, dense boolean"

    def matched(some: DataFrame, most: int | None) -> DataFrame:
        dealt = some.repartition(n, "key").sortWithinPartitions("key")
        return materialize(dealt.mapInArrow(_match(most), schema), "line-candidates", release=True)

    found = matched(rows, DENSE)
    pairs, dense = found.where("not dense").select("a", "b"), found.where("dense")
    if not dense.isEmpty():
        width = 64 // (MAX_FLIPS + 1)
        part = F.explode(F.array(*[
            F.xxhash64("key", F.lit(i), F.shiftrightunsigned("sign", i * width).bitwiseAND(F.lit((1 << width) - 1)))
            for i in range(MAX_FLIPS + 1)
        ]))
        finer = dense.select(part.alias("key"), "probe", "line_id", "sign")
        pairs = pairs.unionByName(matched(finer, None).select("a", "b"))
    pairs = materialize(pairs.distinct(), "line-pairs")
    # Few lines have candidates: if their ids are known to be few, texts of others need not move.
    met = materialize(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct(), "line-met")
    few = met.count() <= MOST_BROADCAST
    texts = long_lines.join(F.broadcast(met) if few else met, "line_id", "left_semi")
    texts = texts.select(F.col("line_id").alias("a"), F.col("line").alias("line_a"))
    both = pairs.join(texts, "a").join(texts.select(F.col("a").alias("b"), F.col("line_a").alias("line_b")), "b")
    return both.select("a", "b", "line_a", "line_b").mapInArrow(_verify, "a long, b long")


def distinct_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every distinct line of ``docs``, white space at its ends cut off: line_id, line, n_rows, doc_id, line_no.

    Empty lines, and null texts, give none.  ``doc_id`` and ``line_no`` (from 0) tell where
    a line stands first, by id and then by place.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.split(F.col(text_column), "\n").alias("lines"))
    each = texts.select("doc_id", F.posexplode("lines").alias("line_no", "line"))
    # The pattern is tried at every sign of a line, so only where a line's ends can match it.
    ragged = F.substring("line", 1, 1).isin(*_SPACE) | F.substring("line", -1, 1).isin(*_SPACE, *_LINE_ENDS)
    trimmed = F.when(ragged, F.regexp_replace("line", r"^\s+|\s+$", "")).otherwise(F.col("line"))
    each = each.withColumn("line", trimmed).where("line <> ''")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line_no")).alias("first")
    counted = each.groupBy("line").agg(F.count("*").alias("n_rows"), first)
    stored = materialize(counted.withColumn("line_id", F.monotonically_increasing_id()), "lines", release=True)
    return stored.select("line_id", "line", "n_rows", "first.doc_id", F.col("first.line_no").cast("long").alias("line_no"))


def line_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Classes of lines that links connect, one row per distinct line (runs jobs).

    Returns doc_id, line_no (where the line stands first), n_rows, n_links (different
    lines within reach), class_doc_id, class_line_no (the class's line that stands first),
    line.  Copies of a line count in ``n_rows`` and are never paired.  Null ids come
    after all others.  Other columns of ``docs`` are not read; an empty table gives no
    rows.
    """
    lines = distinct_lines(docs, id_column, text_column)
    linked = materialize(line_links(lines), "line-links")
    counts = linked.select(F.explode(F.array("a", "b")).alias("line_id")).groupBy("line_id").agg(F.count("*").alias("n_links"))
    classes = components(linked).select(F.col("node").alias("line_id"), "component")
    full = lines.join(counts, "line_id", "left").join(classes, "line_id", "left")
    full = full.withColumn("component", F.coalesce("component", "line_id"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line_no")
    heads = full.where("n_links is not null").groupBy("component").agg(F.min(place).alias("head"))
    named = full.join(heads, "component", "left").withColumn("head", F.coalesce("head", place))
    return named.select(
        "doc_id", "line_no", "n_rows", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("head.doc_id").alias("class_doc_id"), F.col("head.line_no").alias("class_line_no"), "line",
    )
