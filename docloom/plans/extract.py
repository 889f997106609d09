"""End-to-end extraction: load, price, gate, extract, roll up, flatten."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.enums import is_ready
from docloom.operators import ingest as steps
from docloom.operators.extraction import (
    ExtractRule,
    KeyBy,
    answer_documents,
    explode_answers,
    flatten_values,
)
from docloom.operators.jobs import DEFAULT_RATES, JobRequest, roll_up_status, run_jobs
from docloom.operators.projects import get_or_create_projects
from docloom.operators.selectors import Catalog, select_documents
from docloom.plans.ingest import ingest_files
from docloom.session import materialize

PAGE_CHARS = 3000


class ExtractionFailed(RuntimeError):
    """No document to work on, or every document of the job failed."""


@dataclass(frozen=True)
class ExtractResult:
    """Tables of one run; ``outcomes`` is there only when files were loaded.

    ``job`` is one row, ``documents`` the ids it touched with their status.
    """

    job: DataFrame
    documents: DataFrame
    results: DataFrame
    values: DataFrame
    outcomes: DataFrame | None = None
    new_documents: DataFrame | None = None
    project_documents: DataFrame | None = None


def extract(
    catalog: Catalog,
    rules: Sequence[ExtractRule],
    *,
    files: DataFrame | None = None,
    document_ids: Sequence[int] | DataFrame | None = None,
    selectors: dict[str, Any] | None = None,
    project_id: int | None = None,
    project_name: str | None = None,
    projects: DataFrame | None = None,
    jobs: DataFrame | None = None,
    flatten: bool = True,
    max_size: int | None = None,
    max_credits: int | None = None,
    rates: dict[str, int] = DEFAULT_RATES,
    key_by: KeyBy = "name",
    raise_on_failure: bool = True,
    base_key: str = "extract",
    spread: int | None = None,
) -> ExtractResult:
    """Run the prompts in ``rules`` over files, documents or a selection (runs jobs).

    Exactly one of ``files``, ``document_ids`` and ``selectors``.  The catalog's
    documents carry ``text``; ``files`` has ``path, size, md5, folder_id, text``.
    A rejected file that holds an id (its name is taken) still takes part, over the
    document that has the name; without any id nothing is priced.  The budget is
    checked before the job starts; its id follows the largest one in ``jobs``.  A failed job raises unless told otherwise, a
    partial success returns.  A document without text fails.

    Texts are read where they lie: each is scanned once, and only the short
    answers are shuffled, joined and written.  ``spread`` deals them to that many tasks
    first, for inputs whose files cannot be split.
    """
    if sum(x is not None for x in (files, document_ids, selectors)) != 1:
        raise ValueError("give exactly one of files, document_ids and selectors")
    if files is None and project_name is not None:
        raise ValueError("project_name needs files; give project_id instead")
    if project_name is not None and projects is None:
        raise ValueError("project_name needs the projects table")

    held = catalog.documents
    outcomes = loaded = members = None
    if files is not None:
        pages = F.greatest(F.lit(1), F.ceil(F.length("text") / PAGE_CHARS)).alias("page_count")
        plain = files.select("path", "size", "md5", "folder_id", pages)
        ingested = ingest_files(
            plain, held, base_key=base_key, flatten=flatten, max_size=max_size
        )
        outcomes = ingested.outcomes
        document_ids = steps.document_ids(outcomes).distinct()
        if document_ids.isEmpty():
            raise ExtractionFailed("no documents to process: every file was rejected")
        loaded = outcomes.where("uploaded").select(
            F.col("document_id").alias("id"), "page_count", F.lit("ready").alias("status"), "path"
        )
        priced = [c for c in ("id", "page_count", "status") if c in held.columns]
        catalog = replace(
            catalog, documents=held.select(*priced).unionByName(loaded.select(*priced))
        )
        if project_name is not None:
            names = files.sparkSession.createDataFrame([(project_name,)], "name string")
            project_id = get_or_create_projects(projects, names).resolved.first()["id"]
        if project_id is not None:
            members = steps.pin_project(outcomes, project_id)

    request = JobRequest(
        step="extractor",
        selectors=selectors,
        document_ids=document_ids,
        prompts=[rule.prompt_id for rule in rules],
        max_credits=max_credits,
        project_id=None if files is not None else project_id,
        key=base_key,
    )
    started = run_jobs(catalog, [request], rates=rates, strict=True, jobs=jobs)
    reserved = started.job_documents.select("document_id")
    if "status" in held.columns:
        ids = reserved.select(F.col("document_id").alias("id"))
        chosen = held.select("id", "status").join(ids, "id", "left_semi")
        if not chosen.where(~is_ready(F.col("status"))).isEmpty():
            raise ExtractionFailed("some documents are not ready")

    if selectors is not None:
        # The selection again, so that its predicates prune the text scan; the
        # snapshot then decides which answers count.
        sources = select_documents(replace(catalog, documents=held), selectors)
        answered = answer_documents(sources, rules, spread=spread).join(reserved, "document_id", "left_semi")
    else:
        # A join on the documents would shuffle their texts; the answers are short.
        answered = answer_documents(held, rules, spread=spread).join(reserved, "document_id", "left_semi")
        if files is not None:
            by_path = answer_documents(files, rules, id_col="path", spread=spread)
            fresh = loaded.select("path", F.col("id").alias("new_id"))
            answered = answered.unionByName(
                by_path.join(fresh, by_path["document_id"] == fresh["path"]).select(
                    F.col("new_id").alias("document_id"), "has_text", "answers"
                )
            )
    answered = materialize(answered, "answers")
    results = explode_answers(answered, rules)
    finished = F.when(F.col("has_text"), "completed").otherwise("failed").alias("status")
    documents = answered.select("document_id", finished)

    job_id = started.jobs.first()["id"]
    counts = roll_up_status(documents.withColumn("job_id", F.lit(job_id).cast("long")), started.jobs)
    stale = ("total_docs", "completed_docs", "error_count", "status")
    job = materialize(
        started.jobs.drop(*stale).join(counts.withColumnRenamed("job_id", "id"), "id"), "job"
    )
    if raise_on_failure and job.first()["status"] == "failed":
        raise ExtractionFailed("the extraction job failed")
    ids = documents.select(F.col("document_id").alias("id"))
    values = flatten_values(results, documents=ids, key_by=key_by, rules=rules)
    return ExtractResult(job, documents, results, values, outcomes, loaded, members)


def uncovered_files(outcomes: DataFrame, values: DataFrame) -> DataFrame:
    """Files without extraction values, by reason: ``file_name, document_id, reason``.

    A file is judged by its outcome, not by whether it carries an id: a rejected
    file may hold the id of another document that does have values.
    """
    have = values.where(F.col("field_key").isNotNull()).select("document_id").distinct()
    flagged = outcomes.join(have.withColumn("has_values", F.lit(True)), "document_id", "left")
    reason = (
        F.when(F.col("skipped_as_duplicate"), "skipped_as_duplicate")
        .when(F.col("error").isNotNull(), F.col("error.code"))
        .when(~F.col("uploaded"), "not_uploaded")
        .when(F.col("has_values").isNull(), "no_values")
    )
    return flagged.select("file_name", "document_id", reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )
