"""Wide CSV sink for extraction values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.extraction import field_columns, pivot_values


def wide_table(flat: DataFrame, fields: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """``document_id`` and the sorted fields, blank (empty text) where missing.

    Without ``fields`` the distinct ones are looked up first (runs a job).
    """
    pairs = field_columns(flat) if fields is None else sorted(fields, key=lambda p: (p[1], p[0]))
    wide = pivot_values(flat, pairs)
    cells = []
    for name in wide.columns:
        if name != "document_id":
            quoted = "`" + name.replace("`", "``") + "`"
            cells.append(F.coalesce(F.col(quoted), F.lit("")).alias(name))
    return wide.select("document_id", *cells)


def write_wide_csv(
    flat: DataFrame, path: str, fields: Sequence[tuple[str, str]] | None = None
) -> None:
    """Write the wide table as CSV with a header, in as many files as partitions."""
    wide_table(flat, fields).write.option("header", True).option("emptyValue", "").csv(path)
