"""Projects: get-or-create by exact name, create sets, document assignment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.joins import settled
from docloom.operators.ordinals import with_dense_ordinal
from docloom.operators.selectors import Catalog, select_documents


@dataclass(frozen=True)
class ProjectNames:
    """``projects`` is the whole table afterwards, ``resolved`` name to id."""

    projects: DataFrame
    created: DataFrame
    resolved: DataFrame


def _next_id(table: DataFrame) -> int:
    return (table.agg(F.max("id")).first()[0] or 0) + 1


def get_or_create_projects(
    projects: DataFrame, names: DataFrame, *, organization_id: str = "org",
    created_at: Column | None = None,
) -> ProjectNames:
    """Resolve a column of names, exact and case-sensitive (runs a job).

    Of equal names the smallest id is taken.  A missing name is created once; a
    writer that loses a race re-reads the table and resolves to the winner,
    because resolution never depends on who created a row.
    """
    wanted = names.select(F.col(names.columns[0]).alias("name")).distinct()
    known = projects.groupBy("name").agg(F.min("id").alias("id"))
    absent = wanted.join(known, "name", "left_anti")
    fresh = with_dense_ordinal(absent, ["name"], "id", start=_next_id(projects)).select(
        "id",
        F.lit(organization_id).alias("organization_id"),
        "name",
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )
    found = wanted.join(known, "name").select("name", "id", F.lit(False).alias("was_created"))
    made = fresh.select("name", "id", F.lit(True).alias("was_created"))
    table = projects.unionByName(fresh, allowMissingColumns=True)
    return ProjectNames(table, fresh, found.unionByName(made))


@dataclass(frozen=True)
class CreatedProjects:
    projects: DataFrame
    created: DataFrame
    conflicts: DataFrame


def create_projects(
    projects: DataFrame, wanted: DataFrame, *, organization_id: str = "org",
    created_at: Column | None = None,
) -> CreatedProjects:
    """Create projects ``request_id, name`` (runs a job); a taken name is a conflict row.

    A name asked for twice goes to the smaller request id.
    """
    taken = projects.select("name").distinct()
    free = wanted.join(settled(taken), "name", "left_anti")
    winners = free.groupBy("name").agg(F.min("request_id").alias("request_id"))
    fresh = with_dense_ordinal(winners, ["request_id"], "id", start=_next_id(projects)).select(
        "id",
        F.lit(organization_id).alias("organization_id"),
        "name",
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        "request_id",
    )
    conflicts = wanted.join(fresh.select("request_id"), "request_id", "left_anti").select(
        "request_id", "name", F.lit("NAME_ALREADY_EXISTS").alias("code")
    )
    created = fresh.drop("request_id")
    return CreatedProjects(
        projects.unionByName(created, allowMissingColumns=True), created, conflicts
    )


@dataclass(frozen=True)
class Assignment:
    """``members`` is the whole membership table afterwards, ``added`` its new rows."""

    members: DataFrame
    added: DataFrame
    summary: DataFrame


def assign_documents(
    catalog: Catalog,
    selectors: dict[str, Any] | None = None,
    *,
    document_ids: Sequence[int] | DataFrame | None = None,
    project_id: int,
    added_at: Column | None = None,
) -> Assignment:
    """Add the selected documents to a project; members already there are skipped.

    For a project given by name, resolve it first with
    :func:`get_or_create_projects`.  The summary row holds matched, added, skipped.
    """
    chosen = select_documents(catalog, selectors, document_ids=document_ids, required=True)
    members = catalog.table("project_documents")
    inside = (
        members.where(F.col("project_id") == project_id)
        .select("document_id")
        .distinct()
        .withColumn("member", F.lit(True))
    )
    ids = chosen.select(F.col("id").alias("document_id"))
    judged = ids.join(inside, "document_id", "left")
    is_new = F.col("member").isNull()
    added = judged.where(is_new).select(
        F.lit(project_id).cast("long").alias("project_id"),
        "document_id",
        (F.current_timestamp() if added_at is None else added_at).alias("created_at"),
    )
    summary = judged.agg(
        F.lit(project_id).cast("long").alias("project_id"),
        F.count("*").alias("matched"),
        F.count_if(is_new).alias("added"),
        F.count_if(~is_new).alias("skipped"),
    )
    return Assignment(members.unionByName(added, allowMissingColumns=True), added, summary)
