"""Work of a stream's task on its own rows, before they are dealt out by key."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys that a task holds at a time; beyond them it hands on what it has.
MOST_KEYS = 200_000

#: Groups that the keys of a stateful step are dealt to.  A call of a step costs milliseconds, a key in it
#: microseconds.  It is part of a stream's state: a checkpoint is read with the number it was written with.
BUCKETS = 8192


def bucket_of(key: str) -> Column:
    """The group of a key; keys that are null have one of their own."""
    hashed = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS))
    return F.when(F.col(key).isNotNull(), hashed)


def plain_values(values: pd.Series, *, missing: bool = False) -> list:
    """The keys of a bucket's frame as Python values; all of them are null in the bucket of the null keys."""
    return [None] * len(values) if missing else values.tolist()


def _least(rows: pa.Table, key: str, order: Sequence[str], top: str) -> pa.Table:
    """The first row by ``order`` of each key (nulls last), with the largest ``top`` of all its rows."""
    codes = pc.dictionary_encode(rows[key].combine_chunks(), null_encoding="encode").indices
    coded = pa.table([codes, *(rows[c] for c in order)], ["__code", *(f"__{n}" for n in range(len(order)))])
    place = pc.sort_indices(coded, sort_keys=[(c, "ascending") for c in coded.column_names])
    code = codes.take(place).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    tops = rows[top].combine_chunks().take(place).to_numpy(zero_copy_only=False)
    kept = rows.take(place.take(pa.array(starts)))
    highest = pa.array(np.maximum.reduceat(tops, starts), pa.int64())
    return kept.set_column(kept.column_names.index(top), top, highest)


def earliest_rows(stream: DataFrame, key: str, order: Sequence[str], time: str) -> DataFrame:
    """At most one row per key and task, the first by ``order``; ``time`` becomes the latest time of the key's rows.

    A stateful step that looks for the first row of a key finds the same one, but a key
    that holds a third of all rows reaches it as one row per task of the micro-batch, and
    the watermark still sees the latest time.  Rows without a time are left out.
    """
    timed = stream.where(F.col(time).isNotNull()).withColumn("__top", F.unix_micros(time))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = _least(rows if held is None else pa.concat_tables([held, rows]), key, order, "__top")
            if held.num_rows > MOST_KEYS:
                yield from held.combine_chunks().to_batches()
                held = None
        if held is not None:
            yield from held.combine_chunks().to_batches()

    reduced = timed.mapInArrow(scan, timed.schema)
    return reduced.withColumn(time, F.timestamp_micros("__top")).drop("__top")
