"""Mixing sources to target weights by Pfair scheduling.

A source with share w of all slots may run its j-th block (from 0) from its release
floor(j / w) on and must have run it before its deadline ceil((j + 1) / w).  Earliest
deadline first meets all of these, so after any number of slots every source is less
than one block away from its target.  Shares are exact fractions of the weights.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize

#: Slots that a task deals.
CHUNK = 1 << 15
#: Rows of one block.
BLOCK_ROWS = 16
#: Rows numbered by one window group.
SHARD_ROWS = 1 << 13


def exact_shares(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in the exact proportion of the weights; nothing is rounded."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    common = math.lcm(*(x.denominator for x in exact.values()))
    whole = {k: int(x * common) for k, x in exact.items()}
    divisor = math.gcd(*whole.values())
    return {k: x // divisor for k, x in whole.items()}


def dealt(shares: Mapping[str, int], done: Mapping[str, int], slot: int) -> Iterator[str]:
    """The source of each slot from ``slot`` on without end; ``done`` blocks of each source were dealt before it.

    The counts are the whole state, so a schedule can be taken up at any slot.
    """
    total = sum(shares.values())
    waiting = [(done[k] * total // shares[k], k, done[k]) for k in shares]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, bool, int, str, int]] = []
    while True:
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            deadline, rest = divmod(-(j + 1) * total, shares[k])
            # Ties: a window that overlaps the next one first, then the larger share.
            heapq.heappush(ready, (-deadline, not rest, -shares[k], k, j))
        *_, k, j = heapq.heappop(ready)
        yield k
        heapq.heappush(waiting, ((j + 1) * total // shares[k], k, j + 1))
        slot += 1


def pfair(shares: Mapping[str, int]) -> list[str]:
    """The source of each slot of one period (as many slots as shares)."""
    order = dealt(shares, dict.fromkeys(shares, 0), 0)
    return [next(order) for _ in range(sum(shares.values()))]


Phase = tuple[dict[str, int], dict[str, int]]
Chunk = tuple[int, int, int, int, list[int]]


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], most: int = CHUNK) -> tuple[list[Phase], list[Chunk], dict[str, int]]:
    """How the blocks of all sources are laid out until the last is used up.

    In a phase the sources that have blocks left share the slots by their weights; it
    ends with the last block of one of them.  Sources of weight zero wait for all others.
    Returns the phases (shares, blocks dealt before), the chunks of at most ``most``
    slots (phase, first slot, slot in the phase, slots, blocks of each source dealt in
    the phase before) and the slot of each source's last block.  The schedule is walked
    once, but only the chunks' counts are kept.
    """
    before, slot, ends = dict.fromkeys(blocks, 0), 0, {}
    found: list[Phase] = []
    chunks: list[Chunk] = []
    while left := {k: n - before[k] for k, n in sorted(blocks.items()) if n > before[k]}:
        if min(weights[k] for k in left) < 0:
            raise ValueError("a weight is negative")
        heavy = [k for k in left if weights[k]] or list(left)
        shares = exact_shares({k: weights[k] or 1 for k in heavy})
        found.append((shares, dict(before)))
        done, at, used_up = dict.fromkeys(shares, 0), 0, None
        while used_up is None:
            first, counts = at, list(done.values())
            if len(shares) == 1:
                used_up = heavy[0]
                for first in range(0, left[used_up], most):
                    chunks.append((len(found) - 1, slot + first, first, min(most, left[used_up] - first), [first]))
                at = done[used_up] = left[used_up]
                continue
            for k in dealt(shares, done, at):
                done[k] += 1
                at += 1
                if done[k] == left[k]:
                    used_up = k
                if used_up is not None or at - first == most:
                    break
            chunks.append((len(found) - 1, slot + first, first, at - first, counts))
        for k, n in done.items():
            before[k] += n
        slot += at
        ends[used_up] = slot - 1
    return found, chunks, ends


def _places(found: list[Phase]) -> object:
    """Chunks -> rows plan_key, plan_block, slot."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shares, before = found[row["phase"]]
                done = dict(zip(shares, row["counts"], strict=True))
                keys, blocks = [], []
                if len(shares) == 1:
                    ((k, n),) = done.items()
                    keys, blocks = [k] * row["slots"], range(before[k] + n, before[k] + n + row["slots"])
                else:
                    for _, k in zip(range(row["slots"]), dealt(shares, dict(done), row["in_phase"]), strict=False):
                        keys.append(k)
                        blocks.append(before[k] + done[k])
                        done[k] += 1
                slots = np.arange(row["first_slot"], row["first_slot"] + row["slots"])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(blocks, pa.int64()), pa.array(slots, pa.int64())], ["plan_key", "plan_block", "slot"])

    return scan


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    *,
    power: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """The place of every row of ``docs`` in the mixture (runs jobs).

    Returns doc_id, source, source_position, block, slot, mix_position.  ``weights`` maps
    a source to its target weight; a source that is not named gets the mean of those
    that are.  Without ``weights`` a source weighs its rows to the power ``power``.
    A null source is a source of its own, weighted like one that is not named.

    Inside a source rows are in the order of a hash of (id, source), so that is shuffled;
    each ``block_rows`` in a row are a block, the last one of a source may be shorter.
    No row is dropped or repeated: once a source is used up, the others share its slots
    by their weights, and less than one block of deviation holds anew from there.  Rows
    that are equal in id and source are interchangeable.  An empty table gives no rows.

    A large source is numbered in shards of about ``SHARD_ROWS`` rows.  Counts per source
    pass through the driver, which walks the schedule once, block by block, and keeps
    the counts at every ``CHUNK`` slots; tasks deal the slots between them.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(source_column).cast("string").alias("source"))
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rows = rows.withColumn("order", F.xxhash64("doc_id", "key"))
    stored = materialize(rows, "mix-rows")
    shards = max(1, math.ceil(stored.count() / SHARD_ROWS))
    shard = F.pmod(F.shiftrightunsigned("order", 20), F.lit(shards)).cast("int")
    stored = stored.withColumn("shard", shard)
    sizes = materialize(stored.groupBy("key", "shard").agg(F.count("*").alias("n")), "mix-sizes")
    spark = docs.sparkSession
    per_source = {r["key"]: r["n"] for r in sizes.groupBy("key").agg(F.sum("n").alias("n")).collect()}
    schema = "doc_id long, source string, source_position long, block long, slot long, mix_position long"
    if not per_source:
        return spark.createDataFrame([], schema)
    if weights is None:
        chosen = {k: float(n) ** power for k, n in per_source.items()}
    else:
        mean = sum(weights.values()) / len(weights) if weights else 1.0
        chosen = {k: float(weights.get(k[1:], mean)) if k else mean for k in per_source}
    blocks = {k: -(-n // block_rows) for k, n in per_source.items()}
    found, chunks, ends = phases(blocks, chosen)
    table = spark.createDataFrame(chunks, "phase int, first_slot long, in_phase long, slots long, counts array<long>")
    table = table.repartition(len(chunks)).mapInArrow(_places(found), "plan_key string, plan_block long, slot long")
    window = "sum(n) over (partition by key order by shard rows between unbounded preceding and 1 preceding)"
    offsets = sizes.select("key", "shard", F.coalesce(F.expr(window), F.lit(0)).alias("offset"))
    in_shard = F.expr("row_number() over (partition by key, shard order by order, doc_id) - 1")
    numbered = stored.withColumn("in_shard", in_shard).join(offsets, ["key", "shard"])
    placed = numbered.withColumn("source_position", F.col("offset") + F.col("in_shard"))
    placed = placed.withColumn("block", F.floor(F.col("source_position") / block_rows))
    placed = placed.join(table, (placed["key"] == table["plan_key"]) & (placed["block"] == table["plan_block"]))
    # Only the last block of a source can be short: these few shorten what comes after them.
    short = placed.select("doc_id", "source", "source_position", "block", "slot")
    lacking = {k: -n % block_rows for k, n in per_source.items()}
    gaps = F.lit(0).cast("long")
    missing = sorted((ends[k], n) for k, n in lacking.items() if n)
    if missing:
        last = F.split(F.lit(",".join(str(s) for s, _ in missing)), ",").cast("array<bigint>")
        sums, total = [0], 0
        for _, n in missing:
            total += n
            sums.append(total)
        before = F.size(F.filter(last, lambda s: s < F.col("slot")))
        totals = F.split(F.lit(",".join(map(str, sums))), ",").cast("array<bigint>")
        gaps = F.element_at(totals, before + 1)
    within = F.col("source_position") - F.col("block") * block_rows
    position = F.col("slot") * block_rows + within - gaps
    return short.select("doc_id", "source", "source_position", "block", "slot", position.alias("mix_position"))


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, id_column: str = "doc_id", source_column: str = "source", **options: object) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture, as sorted ranges; columns stay as they are.

    Written as files, part after part, they read back in that order.  Rows are found by
    id; rows that share an id stand together at its first place, rows without one at the end.
    """
    order = mix_sources(docs, weights, id_column=id_column, source_column=source_column, **options)
    first = order.groupBy(F.col("doc_id").alias("__id")).agg(F.min("mix_position").alias("__at"))
    joined = docs.join(materialize(first, "mix-order"), docs[id_column] == F.col("__id"), "left")
    return joined.orderBy(F.col("__at").asc_nulls_last()).drop("__id", "__at")
