"""Dense row numbers over a total order, without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize

#: ``monotonically_increasing_id`` puts the partition number above these bits.
_ROW_BITS = 33


def with_dense_ordinal(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "ordinal", start: int = 0
) -> DataFrame:
    """Add ``name`` = start, start+1, … along ``order_by`` (runs a job).

    Rows are range-partitioned and sorted, numbered inside their partition, and
    written once; the per-partition counts (one row per partition, never more
    than the partition count) become starting offsets.  ``order_by`` must be a
    total order for the result to be repeatable.
    """
    local = "__row"
    sorted_rows = df.orderBy(*order_by).withColumn(local, F.monotonically_increasing_id())
    stored = materialize(sorted_rows, "ordinal")
    part = F.shiftrightunsigned(F.col(local), _ROW_BITS)
    counts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    sizes = {row["part"]: row["n"] for row in counts}
    offsets, total = [], start
    for number in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(number, 0)
    starts = F.array(*[F.lit(offset).cast("long") for offset in offsets])
    row_in_part = F.col(local).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ordinal = F.element_at(starts, (part + 1).cast("int")) + row_in_part
    return stored.withColumn(name, ordinal).drop(local)
