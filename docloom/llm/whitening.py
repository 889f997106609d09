"""Embedding whitening from bit-sliced exact cross-products.

Components become integers.  A block of rows is cut into bit planes: plane p of dimension
i holds bit p of that dimension's (shifted) integers, 64 rows to a word.  The cross-product
of two dimensions is then a sum of popcounts of ANDed planes, weighted by powers of two.
Block results are exact integers, so neither the order of rows nor the number of tasks
changes the result; centring happens on the integer sums, and only then come floats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Rows that are sliced at a time.
BLOCK_ROWS = 1 << 13
#: Larger components are held at this limit: beyond it a double has no place for a fraction.
LIMIT = 1 << 52
#: Cross-products travel as two numbers, with so many bits in the lower one.
LOW_BITS = 60


def integers(flat: np.ndarray) -> np.ndarray:
    """``floor(SCALE * c) + SHIFT`` of each component, held at ``LIMIT``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * flat)
    return np.clip(scaled, -LIMIT, LIMIT).astype(np.int64) + SHIFT


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """(dimensions, bits, words) of unsigned integers (rows, dimensions); missing rows of the last word are zero."""
    rows, dims = y.shape
    words = -(-rows // 64)
    padded = np.zeros((dims, words * 64), np.int64)
    padded[:, :rows] = y.T
    planes = [np.packbits((padded >> p) & 1 > 0, axis=1).view(np.uint64) for p in range(bits)]
    return np.stack(planes, axis=1) if planes else np.zeros((dims, 0, words), np.uint64)


def plane_products(planes: np.ndarray) -> list[list[int]]:
    """Cross-products of the dimensions (upper triangle), by weighted AND-popcounts."""
    dims, bits, _ = planes.shape
    weights = [1 << q for q in range(bits)]
    out = [[0] * dims for _ in range(dims)]
    for i in range(dims):
        for p in range(bits):
            counts = np.bitwise_count(planes[i:] & planes[i, p]).sum(axis=2, dtype=np.int64)
            # The weighted sum of counts fits a word unless the planes are many.
            if bits + counts.max(initial=0).item().bit_length() < 62:
                sums = (counts @ np.array(weights, np.int64)).tolist()
            else:
                sums = [sum(int(c) * w for c, w in zip(row, weights, strict=True)) for row in counts]
            for j, s in enumerate(sums, i):
                out[i][j] += s << p
    return out


@dataclass
class Totals:
    """Exact sums over rows: how many, per dimension, and per pair of dimensions (upper triangle)."""

    n: int
    sums: list[int]
    products: list[list[int]]
    low: list[int]
    high: list[int]

    def covariance(self) -> np.ndarray:
        """Centred as integers: n * sum(xy) - sum(x) sum(y), over n squared, each entry rounded once."""
        dims, square = len(self.sums), self.n * self.n
        v = np.zeros((dims, dims))
        for i in range(dims):
            for j in range(i, dims):
                v[i, j] = v[j, i] = (self.n * self.products[i][j] - self.sums[i] * self.sums[j]) / square
        return v


def block_totals(x: np.ndarray) -> Totals:
    """Totals of one block; each dimension is shifted by its own least value, so only its span costs planes."""
    n, dims = x.shape
    low = x.min(axis=0) if n else np.zeros(dims, np.int64)
    y = x - low
    span = int(y.max(initial=0))
    planes = bit_planes(y, span.bit_length())
    ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64)
    least = low.tolist()
    plain = [sum(int(c) << p for p, c in enumerate(row)) for row in ones]
    products = plane_products(planes)
    for i in range(dims):
        for j in range(i, dims):
            products[i][j] += least[i] * plain[j] + least[j] * plain[i] + n * least[i] * least[j]
    sums = [s + n * m for s, m in zip(plain, least, strict=True)]
    return Totals(n, sums, products, least, x.max(axis=0).tolist() if n else least)


def _is_usable(vector: Column) -> Column:
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == math.inf))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """Vectors of dimension ``dims`` in blocks of BLOCK_ROWS (the last is smaller)."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        flat = _matrix(batch.column(batch.num_columns - 1), dims)
        for at in range(0, len(flat), BLOCK_ROWS):
            held.append(flat[at : at + BLOCK_ROWS])
            size += len(held[-1])
            if size >= BLOCK_ROWS:
                joined = np.concatenate(held)
                yield joined[:BLOCK_ROWS]
                held, size = [joined[BLOCK_ROWS:]], size - BLOCK_ROWS
    if size:
        yield np.concatenate(held)


def totals(vectors: DataFrame, dims: int) -> Totals:
    """Totals of all rows of ``vectors`` (one column, array of double, all of length ``dims``; runs a job).

    A task sends one row per pair of dimensions; their sums, bounded by the dimensions
    alone, come to the driver.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, [0] * dims, [LIMIT << 2] * dims, [-LIMIT << 2] * dims
        products = [[0] * dims for _ in range(dims)]
        for flat in _blocks(batches, dims):
            own = block_totals(integers(flat))
            n += own.n
            sums = [a + b for a, b in zip(sums, own.sums, strict=True)]
            low, high = list(map(min, low, own.low)), list(map(max, high, own.high))
            products = [[a + b for a, b in zip(r, s, strict=True)] for r, s in zip(products, own.products, strict=True)]
        if not n:
            return
        # Row -1, -1 is the count, row -1, i the sum of dimension i.
        cells = [(-1, -1, n, 0, 0), *((-1, i, sums[i], low[i], high[i]) for i in range(dims))]
        cells += [(i, j, products[i][j], 0, 0) for i in range(dims) for j in range(i, dims)]
        i, j, value, least, most = zip(*cells, strict=True)
        parts = [i, j, [v & ((1 << LOW_BITS) - 1) for v in value], [v >> LOW_BITS for v in value], least, most]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], ["i", "j", "lo", "hi", "least", "most"])

    rows = (
        vectors.mapInArrow(scan, "i long, j long, lo long, hi long, least long, most long")
        .groupBy("i", "j")
        .agg(
            F.sum(F.col("lo").cast("decimal(38,0)")).alias("lo"),
            F.sum(F.col("hi").cast("decimal(38,0)")).alias("hi"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        .collect()
    )
    cells = {(r["i"], r["j"]): r for r in rows}
    value = {key: int(r["lo"]) + (int(r["hi"]) << LOW_BITS) for key, r in cells.items()}
    return Totals(
        value[-1, -1],
        [value[-1, i] for i in range(dims)],
        [[value[min(i, j), max(i, j)] for j in range(dims)] for i in range(dims)],
        [cells[-1, i]["least"] for i in range(dims)],
        [cells[-1, i]["most"] for i in range(dims)],
    )


@dataclass
class Model:
    """What whitens a vector; its size is bounded by the dimensions."""

    n: int
    sums: list[int]
    axes: np.ndarray  # one column per component, unit length
    values: np.ndarray  # falling eigenvalues
    explained: np.ndarray
    narrow: bool  # do squared deviations fit a long?

    @classmethod
    def of(cls, found: Totals, components: int) -> Model:
        v = found.covariance()
        values, axes = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        trace = sum(found.n * found.products[i][i] - s * s for i, s in enumerate(found.sums)) / (found.n * found.n)
        values = np.where(values > values.max(initial=0) * len(v) * 2**-52, values, 0.0)[order]
        spans = zip(found.low, found.high, found.sums, strict=True)
        most = sum(max(found.n * high - s, s - found.n * low) ** 2 for low, high, s in spans)
        explained = values / trace if trace else np.zeros(len(values))
        return cls(found.n, found.sums, axes[:, order], values, explained, most < 1 << 63)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without variance gives NaN."""
        centre = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (x - centre) @ self.axes / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row the sum of (n x - S)^2, exact."""
        if self.narrow:
            gaps = self.n * x - np.array(self.sums, np.int64)
            return (gaps * gaps).sum(axis=1).tolist()
        return [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums, strict=True)) for row in x.tolist()]


def _identity_error(vectors: DataFrame, shared: Shared, dims: int, kept: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity (runs a job); 0 without components."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums, products = shared.get(), np.zeros(kept), np.zeros((kept, kept))
        for flat in _blocks(batches, dims):
            w = model.project(integers(flat))[:, :kept]
            sums, products = sums + w.sum(axis=0), products + w.T @ w
        i, j = np.indices((kept + 1, kept)).reshape(2, -1)
        values = np.concatenate([products.ravel(), sums])
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(values)], ["i", "j", "value"])

    if not kept:
        return 0.0
    rows = vectors.mapInArrow(scan, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    table = np.zeros((kept + 1, kept))
    for row in rows.collect():
        table[row["i"], row["j"]] = row["value"]
    n = shared.get().n
    mean = table[kept] / n
    return float(np.abs(table[:kept] / n - np.outer(mean, mean) - np.eye(kept)).max())


_COLUMNS = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_text string"
)


def _whiten(vectors: DataFrame, dims: int, components: int) -> DataFrame:
    narrow = vectors.select("v")
    model = Model.of(totals(narrow, dims), components)
    shared = Shared(vectors.sparkSession, model)
    error = _identity_error(narrow, shared, dims, int((model.values > 0).sum()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        k = len(own.values)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = integers(_matrix(part.column(1), dims))
                rows = len(x)
                far, white = own.deviations(x), own.project(x).ravel()
                ids = part.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
                deviations = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, own.n)),
                    deviations.take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(own.explained, rows)),
                    pa.array(np.full(rows * k, error)),
                    pa.array(list(map(str, far)), pa.string()).take(pa.array(np.repeat(np.arange(rows), k))),
                ]
                names = [name.split(" ")[0] for name in _COLUMNS.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return vectors.mapInArrow(scan, _COLUMNS)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """The leading principal components of every vector, scaled to unit variance (runs jobs).

    One row per vector and component: vec_id, component (from 1, by falling variance), n
    (vectors fitted), deviation, whitened, explained, identity_error, deviation_exact.
    All vectors are fitted: nothing is sampled.  Vectors that are null or hold null, NaN or
    infinite entries are left out.  Zero vectors, repeated rows and null ids take part like
    any other.  Vectors of different lengths have no covariance with each other: each
    length is a fit of its own (a job per length), with its own n.

    ``deviation`` is null where the exact sum exceeds a long (from some million vectors on);
    ``deviation_exact`` (decimal text) always holds it.  Where fewer directions vary
    than components are asked for, the rest have ``whitened`` null and ``explained`` 0, and
    ``identity_error`` is that of the others.  There are at most as many components as
    dimensions; empty vectors have none, so no rows.  Components beyond 2**52 / 1024 are
    held there.  Other columns are not read; an empty table gives no rows.
    """
    usable = vectors.where(_is_usable(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")
    )
    lengths = sorted(r["dims"] for r in usable.select(F.size("v").alias("dims")).distinct().collect())
    parts = [_whiten(usable.where(F.size("v") == d), d, min(d, components)) for d in lengths if d]
    found = vectors.sparkSession.createDataFrame([], _COLUMNS) if not parts else parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("deviation_text", "deviation_exact")
