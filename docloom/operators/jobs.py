"""Jobs and cost: quotes, estimates, budget gate, start, roll-up, results."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.enums import STEPS, is_terminal
from docloom.operators.extraction import attach_results
from docloom.operators.ordinals import with_dense_ordinal
from docloom.operators.selectors import (
    Catalog,
    combine,
    select_documents,
    selection_predicate,
    touched_by,
)
from docloom.session import materialize

#: Credits per page and step; prices are the caller's data, these only defaults.
DEFAULT_RATES = {"splitter": 1, "classifier": 1, "extractor": 1}


class BudgetExceeded(ValueError):
    """The estimate is above the budget; nothing was started."""

    def __init__(self, total_credits: int, max_credits: int) -> None:
        super().__init__(f"estimate of {total_credits} credits exceeds the budget of {max_credits}")
        self.total_credits = total_credits
        self.max_credits = max_credits


def page_credits(step: str, prompts: Sequence[int] | None, rates: dict[str, int]) -> int:
    """Credits for one page: the step's rate, times the prompts for an extractor."""
    if step not in rates:
        raise ValueError(f"no rate for step {step!r}; known steps are {', '.join(STEPS)}")
    return rates[step] * (len(prompts or ()) if step == "extractor" else 1)


def quote(
    selection: DataFrame,
    step: str,
    *,
    prompts: Sequence[int] | None = None,
    rates: dict[str, int] = DEFAULT_RATES,
) -> DataFrame:
    """One row ``total_credits, page_count, document_count``; nothing is reserved."""
    pages = F.coalesce(F.sum(F.ceil("page_count")), F.lit(0)).cast("long")
    return selection.agg(
        (pages * page_credits(step, prompts, rates)).alias("total_credits"),
        pages.alias("page_count"),
        F.count("*").alias("document_count"),
    )


@dataclass(frozen=True)
class JobRequest:
    """A step over a selection.  ``key`` tells apart requests that are otherwise alike."""

    step: str
    selectors: dict[str, Any] | None = None
    document_ids: Sequence[int] | DataFrame | None = None
    prompts: Sequence[int] = field(default_factory=tuple)
    max_credits: int | None = None
    project_id: int | None = None
    key: str = ""

    def estimate_id(self) -> str:
        """Same request, same id: estimating again does not reserve twice.

        A table of ids is not read for this, so such a request is told by its ``key``.
        """
        ids = self.document_ids
        if isinstance(ids, DataFrame) and not self.key:
            raise ValueError("a request for a table of ids needs a key")
        body = {
            "step": self.step,
            "selectors": self.selectors,
            "document_ids": "table" if isinstance(ids, DataFrame) else ids and list(ids),
            "prompts": list(self.prompts),
            "key": self.key,
        }
        text = json.dumps(body, sort_keys=True, default=str)
        return "est-" + hashlib.sha256(text.encode()).hexdigest()[:24]


@dataclass(frozen=True)
class Estimates:
    """``estimates`` has one row per request; ``reserved`` its document snapshot."""

    estimates: DataFrame
    reserved: DataFrame


def reserve(catalog: Catalog, requests: Sequence[JobRequest]) -> DataFrame:
    """``estimate_id, document_id, pages``: what each request selects.

    All requests that only look at the document's own row share one scan, which
    tags each document with the requests that match it.  A request that needs a
    join is a branch of its own.
    """
    pages = F.coalesce(F.ceil("page_count"), F.lit(0)).cast("long").alias("pages")
    document = F.col("id").alias("document_id")
    tags, branches = [], []
    for request in requests:
        tag = F.lit(request.estimate_id())
        own_row = selection_predicate(
            catalog, request.selectors, document_ids=request.document_ids
        )
        if own_row is not None:
            tags.append(F.when(own_row, tag))
            continue
        chosen = select_documents(
            catalog, request.selectors, document_ids=request.document_ids, required=True
        )
        branches.append(chosen.select(tag.alias("estimate_id"), document, pages))
    if tags:
        # Outer, because for a plain explode the optimizer filters on the array and so
        # evaluates all predicates twice.
        matching = F.explode_outer(F.array_compact(F.array(*tags))).alias("estimate_id")
        matched = catalog.documents.select(matching, document, pages)
        branches.insert(0, matched.where(F.col("estimate_id").isNotNull()))
    return reduce(DataFrame.unionByName, branches)


def _request_facts(
    spark: SparkSession, requests: Sequence[JobRequest], rates: dict[str, int]
) -> DataFrame:
    rows = [
        (
            request.estimate_id(),
            request.step,
            page_credits(request.step, request.prompts, rates),
            request.max_credits,
            request.project_id,
            _selection_text(request),
        )
        for request in requests
    ]
    return spark.createDataFrame(
        rows,
        "estimate_id string, step string, page_credits long, max_credits long, "
        "project_id long, selectors string",
    )


def price(
    reserved: DataFrame, requests: Sequence[JobRequest], *, rates: dict[str, int] = DEFAULT_RATES
) -> DataFrame:
    """One row per request over its reserved documents; none selected costs nothing."""
    totals = reserved.groupBy("estimate_id").agg(
        F.sum("pages").alias("page_count"), F.count("*").alias("document_count")
    )
    facts = _request_facts(reserved.sparkSession, requests, rates)
    return (
        facts.join(totals, "estimate_id", "left")
        .na.fill(0, ["page_count", "document_count"])
        .select(
            "estimate_id",
            "step",
            (F.col("page_count") * F.col("page_credits")).alias("total_credits"),
            "page_count",
            "document_count",
            "max_credits",
            "project_id",
            "selectors",
        )
    )


def estimate(
    catalog: Catalog, requests: Sequence[JobRequest], *, rates: dict[str, int] = DEFAULT_RATES
) -> Estimates:
    """Snapshot the documents of each request and price the snapshot (runs a job)."""
    if not requests:
        raise ValueError("estimate needs at least one request")
    ids = [request.estimate_id() for request in requests]
    if len(set(ids)) < len(ids):
        raise ValueError("two requests are the same; tell them apart with key")
    reserved = materialize(reserve(catalog, requests), "reserved")
    return Estimates(price(reserved, requests, rates=rates), reserved)


def _selection_text(request: JobRequest) -> str | None:
    if request.selectors is not None:
        return json.dumps(request.selectors, sort_keys=True, default=str)
    if isinstance(request.document_ids, DataFrame) or request.document_ids is None:
        return None
    files = {"type": "fileSelector", "files": list(request.document_ids)}
    return json.dumps(combine(include=[files]), sort_keys=True)


def budget_gate(estimates: DataFrame) -> DataFrame:
    """Add ``admitted``: false only where the total is strictly above ``max_credits``."""
    over = F.col("total_credits") > F.col("max_credits")
    return estimates.withColumn("admitted", ~F.coalesce(over, F.lit(False)))


def require_budget(estimates: DataFrame) -> DataFrame:
    """Raise :class:`BudgetExceeded` for the first rejected estimate (runs a job)."""
    gated = budget_gate(estimates)
    rejected = gated.where(~F.col("admitted")).orderBy("estimate_id").first()
    if rejected is not None:
        raise BudgetExceeded(rejected["total_credits"], rejected["max_credits"])
    return gated


def next_job_id(jobs: DataFrame | None) -> int:
    """One more than the largest id of a jobs table (runs a job); 1 without jobs."""
    return 1 if jobs is None else (jobs.agg(F.max("id")).first()[0] or 0) + 1


@dataclass(frozen=True)
class StartedJobs:
    jobs: DataFrame
    job_documents: DataFrame
    rejected: DataFrame


def start_jobs(
    gated: DataFrame,
    reserved: DataFrame,
    *,
    first_id: int = 1,
    organization_id: str = "org",
    organization_name: str = "Org",
    created_at: Column | None = None,
) -> StartedJobs:
    """Job and job-document rows for the admitted estimates (runs a job).

    Job ids follow ``first_id`` in the order of the estimate ids.
    """
    admitted = with_dense_ordinal(
        gated.where("admitted"), ["estimate_id"], "job_id", start=first_id
    )
    jobs = admitted.select(
        F.col("job_id").alias("id"),
        F.lit(organization_id).alias("organization_id"),
        F.lit(organization_name).alias("organization_name"),
        F.col("document_count").alias("total_docs"),
        F.lit(0).cast("long").alias("completed_docs"),
        F.lit(0).cast("long").alias("error_count"),
        F.when(F.col("document_count") > 0, "running").otherwise("completed").alias("status"),
        F.array("step").alias("stages"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        "project_id",
        "selectors",
        F.col("total_credits").alias("credits"),
    )
    job_documents = reserved.join(admitted.select("estimate_id", "job_id"), "estimate_id").select(
        "job_id", "document_id", F.lit("running").alias("status")
    )
    return StartedJobs(jobs, job_documents, gated.where(~F.col("admitted")))


def run_jobs(
    catalog: Catalog,
    requests: Sequence[JobRequest],
    *,
    rates: dict[str, int] = DEFAULT_RATES,
    first_id: int | None = None,
    jobs: DataFrame | None = None,
    strict: bool = False,
    created_at: Column | None = None,
) -> StartedJobs:
    """Estimate, gate and start many requests (runs jobs).

    Ids follow the largest of the ``jobs`` table that the new rows go to; without one
    they start at ``first_id``, or at 1.

    The price and the started documents come from one written snapshot.
    ``strict`` raises on the first request over its budget and starts nothing.
    """
    if first_id is None:
        first_id = next_job_id(jobs)
    priced = estimate(catalog, requests, rates=rates)
    gated = require_budget(priced.estimates) if strict else budget_gate(priced.estimates)
    return start_jobs(gated, priced.reserved, first_id=first_id, created_at=created_at)


def roll_up_status(job_documents: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Per job: total, completed and failed documents, and the status they imply.

    Unfinished documents mean running, all good completed, all bad failed, a mix
    partial success.  With ``jobs``, a job without documents is completed.
    """
    status = F.col("status")
    counts = job_documents.groupBy("job_id").agg(
        F.count("*").alias("total_docs"),
        F.count_if(status == "completed").alias("completed_docs"),
        F.count_if(status == "failed").alias("error_count"),
    )
    if jobs is not None:
        ids = jobs.select(F.col("id").alias("job_id"))
        counts = ids.join(counts, "job_id", "left").na.fill(
            0, ["total_docs", "completed_docs", "error_count"]
        )
    total, done, bad = F.col("total_docs"), F.col("completed_docs"), F.col("error_count")
    implied = (
        F.when(done + bad < total, "running")
        .when(bad == 0, "completed")
        .when(done == 0, "failed")
        .otherwise("partial_success")
    )
    return counts.withColumn("status", implied)


def job_results(
    catalog: Catalog,
    job_ids: Sequence[int],
    results: DataFrame | None = None,
    prompts: Sequence[int] | None = None,
) -> DataFrame:
    """Documents that the jobs touched, with the items of the requested prompts."""
    touched = select_documents(catalog, combine(include=[touched_by(job_ids)]))
    if results is None:
        return touched
    return attach_results(touched, results, prompts)


def with_terminal_flag(jobs: DataFrame, status: str = "status") -> DataFrame:
    """Add ``is_terminal``; a status that is not known is not terminal."""
    return jobs.withColumn("is_terminal", is_terminal(F.col(status)))
