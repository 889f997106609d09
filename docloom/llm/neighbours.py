"""Nearest neighbours by largest inner product: a vantage-point tree per shard.

With M the largest norm of a shard, x -> (x, sqrt(M^2 - |x|^2)) and q -> (q, 0) turn the
largest inner product into the smallest Euclidean distance, so the triangle inequality
holds.  A subtree is left out when ``factor`` times its least possible distance is above
the k-th distance found; factor one keeps the search exact, larger factors trade
neighbours for time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize

#: Vectors of one tree and queries of one block; both stay in one task's memory.
SHARD_ROWS, QUERY_ROWS = 4096, 2048
LEAF = 256
NEIGHBOURS = 20
_NO_ID = np.iinfo(np.int64).max


def _sane(frame: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector, dim of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    rows = frame.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    limit = F.lit(1.7976931348623157e308)
    usable = F.forall("vector", lambda x: F.coalesce((x <= limit) & (x >= -limit) & ~F.isnan(x), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & usable)
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows.withColumn("dim", F.size("vector"))


def _reachable(ids: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the rows that can be nobody's neighbour: of equal vectors the k + 1 smallest ids win every tie."""
    kind = np.unique(points, axis=0, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, kind))
    kind = kind[order]
    rank = np.arange(len(kind)) - np.searchsorted(kind, kind)
    kept = order[rank <= k]
    return ids[kept], points[kept]


class Tree:
    """A vantage-point tree over the rows of a matrix; points of a subtree lie side by side."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        norms = (points * points).sum(axis=1)
        self.top = float(norms.max())
        lifted = np.column_stack([points, np.sqrt(np.maximum(0, self.top - norms))])
        order, nodes = np.argsort(ids, kind="stable"), []
        random = np.random.default_rng(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, stop, parent, side = todo.pop()
            own = order[start:stop]
            node = {"start": start, "stop": stop, "vantage": -1, "children": [-1, -1], "ranges": None}
            nodes.append(node)
            if parent >= 0:
                nodes[parent]["children"][side] = len(nodes) - 1
            if stop - start <= LEAF:
                continue
            vantage = own[random.integers(len(own))]
            far = np.sqrt(((lifted[own] - lifted[vantage]) ** 2).sum(axis=1))
            inside = far <= np.median(far)
            if inside.all():
                inside = far < far.max()
                if not inside.any():
                    continue  # all points are one point
            order[start:stop] = np.concatenate([own[inside], own[~inside]])
            middle = start + int(inside.sum())
            near, out = far[inside], far[~inside]
            node["vantage"], node["ranges"] = int(vantage), ((near.min(), near.max()), (out.min(), out.max()))
            todo += [(start, middle, len(nodes) - 1, 0), (middle, stop, len(nodes) - 1, 1)]
        self.vantages = {i: lifted[n["vantage"]] for i, n in enumerate(nodes) if n["vantage"] >= 0}
        self.nodes = [(n["start"], n["stop"], n["children"], n["ranges"]) for n in nodes]
        self.ids, self.points = ids[order], np.ascontiguousarray(points[order])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query the k best (scores, ids) of this tree, best first; missing ones have id _NO_ID."""
        scores = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), _NO_ID)
        norms = (queries * queries).sum(axis=1)
        slack = 1e-6 * np.sqrt(norms + self.top)
        # More than any two ways of adding up a product can differ.
        error = 8 * queries.shape[1] * np.finfo(float).eps * np.sqrt(norms * self.top)

        def scan(start: int, stop: int, active: np.ndarray) -> None:
            """Matrix products name the pairs that can matter; only those get their exact scores."""
            points, ids = self.points[start:stop], self.ids[start:stop]
            for at in range(0, len(active), 1024):
                some = active[at : at + 1024]
                rough = queries[some] @ points.T
                rough[ids == query_ids[some, None]] = -np.inf
                floor = scores[some, -1]
                if len(ids) > k:  # the k best of this leaf bound the rest of it
                    floor = np.maximum(floor, np.partition(rough, -k, axis=1)[:, -k] - error[some])
                row, column = np.nonzero(rough >= (floor - error[some])[:, None])
                own = ids[column] != query_ids[some[row]]  # where all is -inf, every pair is named
                row, column = row[own], column[own]
                if not len(row):
                    continue
                # Plain left-to-right sums: equal vectors score equally.
                exact = np.cumsum(queries[some[row]] * points[column], axis=1)[:, -1]
                touched = np.unique(row)
                old = some[touched]
                of = np.concatenate([np.repeat(touched, k), row])
                values = np.concatenate([scores[old].ravel(), exact])
                names = np.concatenate([found[old].ravel(), ids[column]])
                order = np.lexsort((names, -values, of))
                of = of[order]
                place = np.arange(len(of)) - np.searchsorted(of, touched)[np.searchsorted(touched, of)]
                best = order[place < k]
                scores[old], found[old] = values[best].reshape(-1, k), names[best].reshape(-1, k)

        def visit(number: int, active: np.ndarray) -> None:
            start, stop, children, ranges = self.nodes[number]
            if ranges is None:
                scan(start, stop, active)
                return
            vantage = self.vantages[number]
            # d^2 = |q|^2 + |v|^2 - 2 q.v, where the lifted v has norm `top` and q no last part.
            far = np.sqrt(np.maximum(0, norms[active] + self.top - 2 * (queries[active] @ vantage[:-1])))
            first = far <= (ranges[0][1] + ranges[1][0]) / 2
            for group, order in ((first, (0, 1)), (~first, (1, 0))):
                for side in order:
                    low, high = ranges[side]
                    mine, distance = active[group], far[group]
                    least = np.maximum(0, np.maximum(low - distance, distance - high))
                    with np.errstate(invalid="ignore"):
                        limit = np.sqrt(np.maximum(0, norms[mine] + self.top - 2 * scores[mine, -1]))
                    keep = ~(factor * least > limit + slack[mine])
                    if keep.any():
                        visit(children[side], mine[keep])

        visit(0, np.arange(len(queries)))
        return scores, found


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    factor: float = 1.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Each query's k vectors of largest inner product: query_id, rank (from 1), vec_id, score (runs jobs).

    Ties go to the smaller id, and a query is no neighbour of its own id.  Vectors that
    are null, all zero, or hold null or non-finite components take no part, nor do rows
    without an id; a query meets only vectors of its own length.  Rows that repeat an id
    count once, as the smallest of their vectors.  With fewer than k candidates all are
    returned; empty tables give no rows.  Other columns are not read.

    Shards are random, so very common vectors spread over all of them.  Every block of
    queries meets every shard once, and sends back k rows per query.
    """
    if factor < 1:
        raise ValueError("factor must be at least 1")

    def once(frame: DataFrame) -> DataFrame:
        return _sane(frame, id_column, vector_column).groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))

    def dealt(frame: DataFrame, size: int, label: str) -> tuple[DataFrame, int]:
        stored = materialize(once(frame), label)
        count = max(1, math.ceil(stored.count() / size))
        return stored.withColumn(label, F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")), count

    points, shards = dealt(vectors, SHARD_ROWS, "shard")
    asked, blocks = dealt(queries, QUERY_ROWS, "block")

    def matrix(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return frame["vec_id"].to_numpy(np.int64), np.stack(frame["vector"].to_list()).astype(np.float64)

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        ids, rows = _reachable(*matrix(frame), k)
        return frame[["dim", "shard"]].head(1).assign(tree=cloudpickle.dumps(Tree(ids, rows)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return frame[["dim", "block"]].head(1).assign(asked=cloudpickle.dumps(matrix(frame)))

    trees = points.groupBy("dim", "shard").applyInPandas(plant, "dim int, shard int, tree binary")
    packs = asked.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, asked binary")
    trees = materialize(trees, "trees").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    packs = materialize(packs, "packs").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = trees.join(packs.hint("merge"), ["dim", "shard", "block"]).select("tree", "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = cloudpickle.loads(batch.column(0)[i].as_py())
                ids, rows = cloudpickle.loads(batch.column(1)[i].as_py())
                scores, found = tree.search(ids, rows, k, factor)
                real = found != _NO_ID
                names = np.broadcast_to(ids[:, None], found.shape)
                yield pa.RecordBatch.from_arrays([pa.array(x[real]) for x in (names, found, scores)], ["query_id", "vec_id", "score"])

    hits = materialize(pairs.mapInArrow(search, "query_id long, vec_id long, score double"), "hits")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
