"""SimHash near duplicates with pigeonring filtering.

A fingerprint is a ring of 8 segments of 8 bits.  If two fingerprints differ in at
most 3 bits, some segment starts a chain in which the first l segments together differ
in at most floor(3 l / 8) bits, for every l.  So two segments in a row are equal and the
next three differ in at most one bit: one half of those 24 bits is equal as well.
These 28 equal bits are the key under which candidates meet; the rest of the chain's
budgets prunes them before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import components, kept_rows, row_digest, slices
from docloom.session import materialize

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 3
SEGMENTS = 8
#: Most different bits in the first 1, 2, ... segments of a chain.
BUDGETS = np.array([MAX_DISTANCE * length // SEGMENTS for length in range(1, SEGMENTS + 1)])
#: A key shared by more fingerprints than this is extended by further equal bits.
DENSE = 1 << 14
_ALL = (1 << 64) - 1
#: Shingles counted at a time, so that a very long text needs little memory.
_CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of one text (unsigned); no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    take = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[take - 1 :].tolist()
    starts = [0, *(ends[: len(words) - take] + 1).tolist()]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(stops)
    for at in range(0, n, _CHUNK):
        pairs = zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(line[i:j], SEED) for i, j in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *more: str) -> DataFrame:
    """Rows doc_id, fp (the fingerprint as a signed long) and the binary columns ``more``, one per row of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x) for x in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], ["doc_id", "fp", *more])

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), *more)
    return narrow.mapInArrow(scan, ", ".join(["doc_id long, fp long", *(f"{name} binary" for name in more)]))


def _rotated(bits: int, start: int) -> int:
    """Positions counted from segment ``start`` on (first segment highest) as a mask of the whole ring."""
    shift = SEGMENTS * start
    return ((bits >> shift) | (bits << (64 - shift))) & _ALL


def _first_masks() -> list[tuple[int, int]]:
    """(start, mask of the 28 bits that must be equal): two segments and half of the next three."""
    two, halves = 0xFFFF << 48, (0xFFF << 36, 0xFFF << 24)
    return [(start, _rotated(two | half, start)) for start in range(SEGMENTS) for half in halves]


def _children(mask: int) -> list[int]:
    """``mask`` with a quarter of the free bits each: three differing bits leave one quarter equal."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    parts = [free[i * len(free) // 4 : (i + 1) * len(free) // 4] for i in range(4)]
    return [mask | sum(1 << bit for bit in part) for part in parts if part]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _chain_holds(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Do the differences ``x`` stay in every budget of the chain from ``start``?  The last one is the full check."""
    per_segment = np.bitwise_count(x.astype(">u8").view(np.uint8).reshape(-1, SEGMENTS))
    turned = per_segment[np.arange(len(x))[:, None], (start[:, None] + np.arange(SEGMENTS)) % SEGMENTS]
    early = np.flatnonzero(turned[:, :5].sum(axis=1) <= BUDGETS[4])
    held = np.zeros(len(x), bool)
    held[early] = (np.cumsum(turned[early], axis=1) <= BUDGETS).all(axis=1)
    return held


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the given links, as few as keep what is connected connected."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            kept.append((a, b))
    return kept


def _small_groups(group: np.ndarray, start: np.ndarray, fp: np.ndarray, node: np.ndarray) -> list[tuple[int, int]]:
    """Links inside runs of equal ``group``, by comparing rows one, two, ... apart."""
    a, b = [], []
    apart, rows = 1, np.arange(len(group) - 1)
    while len(rows):
        rows = rows[rows + apart < len(group)]
        rows = rows[group[rows] == group[rows + apart]]
        hit = rows[_chain_holds(fp[rows] ^ fp[rows + apart], start[rows])] if len(rows) else rows
        a.append(node[hit])
        b.append(node[hit + apart])
        apart += 1
    return _forest(zip(np.concatenate(a).tolist(), np.concatenate(b).tolist(), strict=True)) if a else []


def _large_group(start: int, fp: np.ndarray, node: np.ndarray) -> list[tuple[int, int]]:
    """Links that span one large group: a search that compares reached fingerprints with unreached ones only."""
    left, links = np.arange(1, len(fp)), []
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        at = queue.pop()
        held = _chain_holds(fp[left] ^ fp[at], np.full(len(left), start))
        reached, left = left[held], left[~held]
        links += [(int(node[at]), int(node[x])) for x in reached]
        queue += reached.tolist()
    return links


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (start, mask, value, fp, node) rows -> links, and the rows of keys that are too dense."""
    kept: list[np.ndarray] = []

    def out(links: list[tuple[int, int]], dense: np.ndarray | None = None) -> pa.RecordBatch:
        found = np.array(links, np.int64).reshape(-1, 2)
        more = np.zeros((0, 5), np.int64) if dense is None else dense
        pad, zero = np.zeros(len(found), np.int64), np.zeros(len(more), np.int64)
        columns = [
            np.concatenate([found[:, 0], zero]), np.concatenate([found[:, 1], zero]),
            *(np.concatenate([pad, more[:, i]]) for i in (0, 1, 3, 4)),
        ]
        flags = np.concatenate([np.zeros(len(found), bool), np.ones(len(more), bool)])
        names = ["a", "b", "start", "mask", "fp", "node", "dense"]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(flags)], names)

    def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.cumsum((np.diff(rows[:, :3], axis=0, prepend=rows[:1, :3] - 1) != 0).any(axis=1))
        sizes = np.bincount(group)[group]
        fp = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        few = (sizes > 1) & (sizes <= 64)
        if few.any():
            yield out(_small_groups(group[few], rows[few, 0], fp[few], rows[few, 4]))
        for g in np.unique(group[sizes > 64]):
            own = np.flatnonzero(group == g)
            yield out(_large_group(int(rows[own[0], 0]), fp[own], rows[own, 4]))

    size, streaming = 0, None
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        while len(rows):
            if streaming is not None:  # inside a dense key: pass its rows on as they come
                same = (rows[:, :3] == streaming).all(axis=1)
                stop = len(rows) if same.all() else int(np.argmin(same))
                if stop:
                    yield out([], rows[:stop])
                rows = rows[stop:]
                if len(rows):
                    streaming = None
                continue
            kept.append(rows)
            size += len(rows)
            held = np.concatenate(kept)
            cut = int(np.argmax((held[:, :3] == held[-1, :3]).all(axis=1)))
            if cut:
                yield from done(held[:cut])
            kept, size, rows = [held[cut:]], size - cut, rows[:0]
            if size > DENSE:
                yield out([], kept[0])
                streaming, kept, size = kept[0][-1, :3], [], 0
    if size:
        yield from done(np.concatenate(kept))


def _keyed(rows: DataFrame, masks: dict[tuple[int, int], list[tuple[int, int]]] | None) -> DataFrame:
    """One row for each mask under which a fingerprint can meet others."""
    if masks is None:
        pairs = F.array(*[F.struct(F.lit(s).cast("long").alias("start"), F.lit(_signed(m)).alias("mask")) for s, m in _first_masks()])
    else:
        table = [(s, _signed(m), _signed(child)) for (s, m), children in masks.items() for _, child in children]
        next_masks = rows.sparkSession.createDataFrame(table, "start long, mask long, child long")
        grown = rows.join(F.broadcast(next_masks), ["start", "mask"])  # 4 rows for each mask of this level
        return grown.select("start", F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("value"), "fp", "node")
    each = rows.select("fp", "node", F.explode(pairs).alias("p"))
    return each.select("p.start", "p.mask", F.col("fp").bitwiseAND(F.col("p.mask")).alias("value"), "fp", "node")


def links(nodes: DataFrame) -> DataFrame:
    """Links a–b that connect all fingerprints within 3 bits (runs jobs).

    ``nodes`` has one row per distinct fingerprint: fp, node (long).  Not every pair of
    a dense group is emitted, only enough to connect it.  A key with more than ``DENSE``
    fingerprints is not matched in one task: its rows come back under keys with more
    equal bits (a quarter of the free ones each), until no key is dense.  Masks of
    different starts can coincide then, but their budgets differ: the start is part of
    the key.
    """
    found, masks, rows = None, None, nodes
    level = {(s, m): [] for s, m in _first_masks()}
    while True:
        keyed = _keyed(rows, masks)
        n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sorted_rows = keyed.repartition(n, "start", "mask", "value").sortWithinPartitions("start", "mask", "value")
        matched = sorted_rows.mapInArrow(
            _match, "a long, b long, start long, mask long, fp long, node long, dense boolean"
        )
        matched = materialize(matched, "pigeonring")
        new = matched.where("not dense").select("a", "b")
        found = new if found is None else found.unionByName(new)
        rows = matched.where("dense").select("start", "mask", "fp", "node")
        if rows.isEmpty():
            return found
        masks = {(s, m): [(s, c) for c in _children(m)] for s, m in level}
        level = {(s, c): [] for pairs in masks.values() for s, c in pairs}


def _classes(stored: DataFrame) -> DataFrame:
    """Rows fp, component (a fingerprint that names its class) of all fingerprints of ``stored``."""
    nodes = materialize(stored.select("fp", F.col("fp").alias("node")).distinct(), "nodes")
    linked = components(links(nodes))
    return nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Near-duplicate classes: doc_id, fingerprint, component_id for every row of ``docs`` (runs jobs).

    Texts are lower-cased in A-Z and split at ASCII white space; shingles are three words
    (the whole text if shorter).  Null and empty texts, and texts of white space, have
    fingerprint zero and are linked like any other.  Fingerprints within 3 bits are
    linked; ``component_id`` is the smallest id that links reach.  Equal fingerprints are
    one node, so copies cost nothing beyond their row.  Repeated rows give repeated rows.
    A row without an id takes part and links others, but only ids can be a
    ``component_id``; it is null where a class has none.  Other columns of ``docs`` are not
    read; an empty table gives no rows.
    """
    stored = materialize(fingerprints(docs, id_column, text_column), "simhash")
    smallest = stored.groupBy("fp").agg(F.min("doc_id").alias("id"))
    named = smallest.join(_classes(stored), "fp")
    heads = named.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = named.join(heads, "component").select("fp", "component_id")
    joined = stored.join(classes.hint("rebalance"), "fp", "left")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class of near copies (three-word shingles, at most 3 bits apart); all columns stay.

    The row of the smallest id stays; a null id is the largest.  Rows of one id go by the
    digest of their text; fully repeated rows leave one.
    """
    keyed = docs.withColumn("__digest", row_digest(text_column))
    prints = fingerprints(keyed.select(id_column, text_column, "__digest"), id_column, text_column, "__digest")
    stored = materialize(prints, "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "__digest")
    least = stored.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    joined = least.join(_classes(stored), "fp")
    heads = joined.groupBy("component").agg(F.min("first").alias("head"), F.sum("n").alias("rows"))
    heads = joined.select("fp", "component").join(heads.where("rows > 1"), "component").select("fp", "head")
    marked = stored.join(heads.hint("rebalance"), "fp")
    same = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("__digest") == F.col("head.__digest"))
    marks = marked.groupBy("doc_id", "__digest").agg(F.bool_or(same).alias("stays"), F.count("*").alias("n"))
    return kept_rows(keyed, materialize(marks.where("not stays or n > 1"), "near-copies"), id_column)
