"""Bulk changes over a selection: move to a folder, delete.

Each returns the new document table and a one-row summary; with a table format
that has MERGE, write the summary's selection instead of the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.selectors import Catalog, select_documents, selection_predicate


@dataclass(frozen=True)
class BulkChange:
    documents: DataFrame
    summary: DataFrame


def move_documents(
    catalog: Catalog,
    selectors: dict[str, Any] | None = None,
    *,
    document_ids: Sequence[int] | DataFrame | None = None,
    target_folder_id: int | None = None,
) -> BulkChange:
    """Move documents into a folder, or to the root; those already there are skipped."""
    chosen = select_documents(catalog, selectors, document_ids=document_ids, required=True)
    target = F.lit(target_folder_id).cast("long")
    there = F.col("folder_id").eqNullSafe(target)
    summary = chosen.agg(
        F.count("*").alias("matched"),
        F.count_if(~there).alias("moved"),
        F.count_if(there).alias("skipped"),
    )
    predicate = selection_predicate(catalog, selectors, document_ids=document_ids)
    if predicate is not None:  # it looks at nothing but the row: one scan, no join
        marked = catalog.documents.withColumn("__hit", predicate)
    else:
        hit = chosen.select("id").distinct().withColumn("__hit", F.lit(True))
        marked = catalog.documents.join(hit, "id", "left")
    folder = F.when(F.col("__hit"), target).otherwise(F.col("folder_id"))
    moved = marked.withColumn("folder_id", folder)
    return BulkChange(moved.select(*catalog.documents.columns), summary)


def delete_documents(
    catalog: Catalog,
    selectors: dict[str, Any] | None = None,
    *,
    document_ids: Sequence[int] | DataFrame | None = None,
    dry_run: bool = False,
) -> BulkChange:
    """Delete the selected documents; a dry run only counts them."""
    chosen = select_documents(catalog, selectors, document_ids=document_ids, required=True)
    summary = chosen.agg(F.count("*").alias("matched"), F.lit(dry_run).alias("dry_run"))
    if dry_run:
        return BulkChange(catalog.documents, summary)
    predicate = selection_predicate(catalog, selectors, document_ids=document_ids)
    if predicate is not None:
        left = catalog.documents.where(~F.coalesce(predicate, F.lit(False)))
        return BulkChange(left, summary)
    return BulkChange(apply_delete_set(catalog.documents, chosen.select("id")), summary)


def apply_delete_set(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents without the given ids; applying it again changes nothing."""
    gone = ids.select(F.col(ids.columns[0]).alias("id")).distinct()
    return documents.join(gone, "id", "left_anti")
