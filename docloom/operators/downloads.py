"""Download plans: safe target names, conflicts with existing and planned files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.names import final_component
from docloom.operators.joins import settled


def plan_downloads(
    documents: DataFrame,
    existing: DataFrame | None = None,
    *,
    overwrite: bool = False,
    name_col: str = "name",
    override_col: str | None = None,
) -> DataFrame:
    """``id, target_name, outcome`` for every document.

    The target is the last component of the name (or of the caller's own name in
    ``override_col``), so it never leaves the target folder.  Outcomes: ``invalid``
    (no usable component), ``exists`` (in the one-column table ``existing``, unless
    overwriting), ``collision`` (a smaller id of this plan takes the name),
    ``write``.
    """
    name = F.col(name_col)
    if override_col is not None:
        name = F.coalesce(F.col(override_col), name)
    plan = documents.select("id", final_component(name).alias("target_name"))
    first = (
        plan.where(F.col("target_name").isNotNull())
        .groupBy("target_name")
        .agg(F.min("id").alias("first_id"))
    )
    plan = plan.join(settled(first), "target_name", "left")
    taken = F.lit(False)
    if existing is not None and not overwrite:
        present = existing.select(F.col(existing.columns[0]).alias("target_name")).distinct()
        present = settled(present.withColumn("__taken", F.lit(True)))
        plan = plan.join(present, "target_name", "left")
        taken = F.coalesce(F.col("__taken"), F.lit(False))
    outcome = (
        F.when(F.col("target_name").isNull(), "invalid")
        .when(taken, "exists")
        .when(F.col("id") > F.col("first_id"), "collision")
        .otherwise("write")
    )
    return plan.select("id", "target_name", outcome.alias("outcome"))


def missing_downloads(documents: DataFrame, existing: DataFrame, **options: str) -> DataFrame:
    """The part of a selection still to be written; names already there are left out."""
    plan = plan_downloads(documents, existing, **options)
    return plan.where(F.col("outcome") == "write").select("id", "target_name")
