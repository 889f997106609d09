"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import materialize


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty string.

    ``lower`` does the same on pure ASCII and is much faster than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def row_digest(text_column: str) -> Column:
    """A digest of a text as it is; a null text's is that of the empty one with a mark."""
    text = F.col(text_column)
    return F.unhex(F.sha2(F.when(text.isNull(), F.lit("\x00null")).otherwise(text), 256))


def kept_rows(keyed: DataFrame, marks: DataFrame, id_column: str) -> DataFrame:
    """``keyed`` (rows with ``__digest``) after a deduplication; ``__digest`` goes (runs a job).

    ``marks`` (doc_id, __digest, stays) names the ids and digests of which not every row
    stays: none, or one.  That one, of rows that differ in other columns, is the least as JSON.
    """
    marks = marks.select(F.col("doc_id").alias("__id"), F.col("__digest").alias("__mark"), "stays")

    def joined(some: DataFrame, how: str) -> DataFrame:
        same = keyed[id_column].cast("long").eqNullSafe(some["__id"]) & (keyed["__digest"] == some["__mark"])
        return keyed.join(some, same, how)

    rest, repeated = joined(marks, "left_anti"), marks.where("stays")
    if not repeated.isEmpty():  # else there is no need to read the texts for them
        columns = [F.col(f"`{c}`") for c in keyed.columns]
        json = F.to_json(F.struct(*[c for c, name in zip(columns, keyed.columns, strict=True) if name != "__digest"]))
        groups = joined(repeated, "left_semi").groupBy(F.col(id_column), F.col("__digest"))
        rest = rest.unionByName(groups.agg(F.min_by(F.struct(*columns), json).alias("__row")).select("__row.*"))
    return rest.drop("__digest")


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (strings) of each holds about ``most_bytes``; one row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch, values
        pa.default_memory_pool().release_unused()


class Shared:
    """A model of bounded size, sent to every executor once.

    A Python process keeps the model it used last, with what it remembers, from task to
    task; others go before the next one is unpacked, so that a long session does not fill
    its memory.
    """

    def __init__(self, spark: SparkSession, model: object) -> None:
        self._packed, self._key = spark.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex

    def get(self) -> object:
        # Functions come anew with each task; the class of broadcasts stays in the process.
        key, model = vars(Broadcast).get("_last_model") or (None, None)
        if key != self._key:
            Broadcast._last_model = model = None
            model = cloudpickle.loads(self._packed.value)
            Broadcast._last_model = self._key, model
        return model


def _canonical(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return edges.select(low.alias("a"), high.alias("b")).where("a < b").distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``a``–``b`` (long): rows ``node``, ``component`` = its smallest node.

    Alternating large and small stars: every round joins the links with the least
    neighbour of each node, one row per node, so a node with very many links is a
    hot key on the splittable side only.  Rounds grow with the logarithm of the
    largest component.  Each round is written to the shared folder (runs jobs);
    nothing is gathered on the driver but one count and one sum.
    """
    edges = materialize(_canonical(edges), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above u hang on the least one around u.
        large = both.where("v > u").join(least.hint("rebalance"), "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        large = materialize(large.where("a < b").distinct(), "large-star")
        # Small star: neighbours below u, and u itself, hang on the least of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low.hint("rebalance"), "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(low.select(F.col("m").alias("a"), "b"))
        edges = materialize(small.where("a < b").distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    leaves = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.unionByName(roots)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best non-decreasing step function as knots and values (pool adjacent violators), pulled to the mean by two rows."""
    order = np.argsort(x, kind="stable")
    mean = float(y.mean())
    pools: list[list[float]] = []  # sum, rows, smallest x, largest x
    for a, b in zip(x[order], y[order], strict=True):
        pools.append([float(b), 1.0, float(a), float(a)])
        while len(pools) > 1 and (pools[-1][2] == pools[-2][3] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
            top = pools.pop()
            pools[-1] = [pools[-1][0] + top[0], pools[-1][1] + top[1], pools[-1][2], top[3]]
    knots, values = [], []
    for s, n, low, high in pools:
        value = (s + 2 * mean) / (n + 2)
        value = max(value, values[-1]) if values else value
        knots += [low, high] if high > low else [low]
        values += [value, value] if high > low else [value]
    return np.array(knots), np.array(values)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """Labelled rows to learn from (runs a job): id, text, label.

    Rows with crc32(id as text) mod 4 of 2 are held out.  If more than ``most`` ids are
    left, a hash of the id chooses about that many, so they can be broadcast.
    """
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.where("id is not null and label is not null and crc32(cast(id as string)) % 4 <> 2")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    share = most / max(most, known.count())
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return texts.join(F.broadcast(chosen), "id").where("text is not null")
