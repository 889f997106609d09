from __future__ import annotations

import datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from docloom.operators import jobs as j
from docloom.operators import replay, waits
from docloom.operators.projects import assign_documents, create_projects, get_or_create_projects
from docloom.operators.bulk import apply_delete_set, delete_documents, move_documents
from docloom.operators.selectors import Catalog, combine, named, paged_between, touched_by, with_ids

NOON = datetime.datetime(2026, 1, 1, 12)


@pytest.fixture()
def catalog(table):
    docs = table("id long, name string, page_count long, folder_id long",
                 (1, "a", 2, None), (2, "b", 3, 5), (3, "c", None, 5), (4, "d", 4, 6))
    members = table("project_id long, document_id long", (7, 1), (7, 9), (8, 2))
    return Catalog(docs, project_documents=members, job_documents=table("job_id long, document_id long", (42, 1), (42, 4)))


def test_quote(catalog):
    assert tuple(j.quote(catalog.documents, "extractor", prompts=[1, 2], rates={"extractor": 3}).first()) == (54, 9, 4)
    assert tuple(j.quote(catalog.documents.where("false"), "splitter").first()) == (0, 0, 0)
    with pytest.raises(ValueError, match="no rate"):
        j.quote(catalog.documents, "dreamer")


@pytest.mark.parametrize(("budget", "admitted"), [(9, True), (8, False), (None, True), (0, False)])
def test_budget_is_strictly_greater(catalog, budget, admitted):
    request = j.JobRequest("splitter", combine(), max_credits=budget)
    priced = j.estimate(catalog, [request])
    assert j.budget_gate(priced.estimates).first()["admitted"] is admitted
    if not admitted:
        with pytest.raises(j.BudgetExceeded) as error:
            j.run_jobs(catalog, [request], strict=True)
        assert (error.value.total_credits, error.value.max_credits) == (9, budget)
    started = j.run_jobs(catalog, [request])
    assert started.jobs.count() == int(admitted) and started.rejected.count() == int(not admitted)


def test_run_many_requests_from_one_snapshot(catalog, table):
    requests = [
        j.JobRequest("splitter", document_ids=[1, 2]),
        j.JobRequest("classifier", combine([touched_by([42])]), project_id=3),
        j.JobRequest("extractor", combine([paged_between(low=3)], [named("d")]), prompts=(1, 2)),
        j.JobRequest("splitter", document_ids=[]),
        j.JobRequest("splitter", document_ids=table("id long", (3,), (99,)), key="table"),
    ]
    started = j.run_jobs(catalog, requests, first_id=100)
    ids = {r.estimate_id(): n for n, r in enumerate(requests)}
    priced = {ids[r["estimate_id"]]: (r["document_count"], r["total_credits"]) for r in j.estimate(catalog, requests).estimates.collect()}
    assert priced == {0: (2, 5), 1: (2, 6), 2: (1, 6), 3: (0, 0), 4: (1, 0)}
    assert tuples(started.jobs, "id") == [(100 + n,) for n in range(5)]
    assert dict(tuples(started.jobs, "total_docs", "status"))[0] == "completed"
    docs = started.job_documents.join(started.jobs.select(F.col("id").alias("job_id"), "stages"), "job_id")
    assert sorted((r["stages"][0], r["document_id"]) for r in docs.collect()) == [
        ("classifier", 1), ("classifier", 4), ("extractor", 2), ("splitter", 1), ("splitter", 2), ("splitter", 3)]


def test_equal_requests_need_a_key(catalog):
    twice = [j.JobRequest("splitter", combine()), j.JobRequest("splitter", combine())]
    with pytest.raises(ValueError, match="key"):
        j.estimate(catalog, twice)
    twice[1] = j.JobRequest("splitter", combine(), key="again")
    assert j.estimate(catalog, twice).estimates.count() == 2


def test_status_roll_up(table):
    docs = table("job_id long, status string", (1, "completed"), (1, "completed"), (2, "failed"), (3, "completed"),
                 (3, "failed"), (4, "running"), (4, "failed"), (6, "odd"))
    got = dict(tuples(j.roll_up_status(docs, table("id long", *[(n,) for n in range(1, 7)])), "job_id", "status"))
    assert got == {1: "completed", 2: "failed", 3: "partial_success", 4: "running", 5: "completed", 6: "running"}


def test_terminal_and_unknown(table):
    jobs = table("id long, status string", (1, "completed"), (2, "failed"), (3, "partial_success"), (4, "running"),
                 (5, "creating_workflows"), (6, "queued"), (7, None))
    done = {r["id"] for r in j.with_terminal_flag(jobs).where("is_terminal").collect()}
    assert done == {1, 2, 3}


def test_job_results(catalog, table):
    results = table("document_id long, prompt_id long, name string, raw_value string", (1, 5, "Total", "9"), (1, 6, "x", "y"), (2, 5, "z", "z"))
    got = j.job_results(catalog, [42], results, [5])
    assert tuples(got, "id", "prompt_id", "raw_value") == [(1, 5, "9"), (4, None, None)]


def events_of(table, *rows):
    return table("subject_id long, status string, ts timestamp", *[
        (s, status, NOON + datetime.timedelta(seconds=sec)) for s, status, sec in rows])


def test_readiness(table):
    events = events_of(table, (1, "processing", 0), (1, "ready", 5), (2, "ready", 1), (2, "processing", 2), (3, "quarantined", 0))
    wanted = table("set_id long, document_id long", (1, 1), (1, 1), (2, 1), (2, 2), (3, 404), (4, 3))
    got = {r["set_id"]: (r["requested"], r["ready"], r["missing"], r["all_ready"]) for r in waits.readiness(wanted, events).collect()}
    assert got == {1: (1, 1, 0, True), 2: (2, 1, 0, False), 3: (1, 0, 1, False), 4: (1, 0, 0, False)}
    assert tuple(waits.all_ready(table("id long"), events).first()) == (0, 0, True)


def test_deadlines(table):
    opened = table("subject_id long, started_at timestamp", *[(n, NOON) for n in range(1, 6)])
    events = events_of(table, (1, "completed", 1800), (2, "completed", 1801), (3, "running", 10), (4, "failed", -60), (5, "queued", 1))
    late = F.lit(NOON + datetime.timedelta(hours=9))
    got = dict(tuples(waits.wait_outcomes(opened, events, observed_until=late), "subject_id", "outcome"))
    assert got == {1: "done", 2: "timeout", 3: "timeout", 4: "done", 5: "timeout"}
    early = F.lit(NOON + datetime.timedelta(seconds=1799))
    got = dict(tuples(waits.wait_outcomes(opened, events, observed_until=early), "subject_id", "outcome"))
    assert got[3] == "waiting"
    for forever in (None, 0, -1):
        got = dict(tuples(waits.wait_outcomes(opened, events, max_wait_seconds=forever), "subject_id", "outcome"))
        assert got == {1: "done", 2: "done", 3: "waiting", 4: "done", 5: "waiting"}
    assert (waits.JOB_WAIT_SECONDS, waits.DOCUMENT_WAIT_SECONDS) == (1800.0, 600.0)
    assert tuples(waits.unknown_statuses(events)) == [(5, "queued")]


def test_replay(table):
    requests = table("key string, payload_hash string, ts long, request_id long",
                     ("k", "a", 2, 11), ("k", "a", 1, 10), ("k", "b", 3, 12), ("l", None, 1, 20), ("l", None, 1, 21))
    got = {r["request_id"]: (r["outcome"], r["answered_by"]) for r in replay.replay_requests(requests).collect()}
    assert got == {10: ("executed", 10), 11: ("replayed", 10), 12: ("rejected", None), 20: ("executed", 20), 21: ("replayed", 20)}
    assert tuples(replay.misused_keys(requests)) == [("k", 3, 1)]


def test_get_or_create_is_exact(table):
    projects = table("id long, name string", (8, "Q1 Invoices (old)"), (7, "Q1 Invoices"), (9, "Q1 Invoices"))
    names = table("name string", ("Q1 Invoices",), ("q1 invoices",), ("New",), ("New",))
    out = get_or_create_projects(projects, names)
    assert tuples(out.resolved, "name", "id", "was_created") == [("New", 10, True), ("Q1 Invoices", 7, False), ("q1 invoices", 11, True)]
    again = get_or_create_projects(out.projects, names)
    assert again.created.isEmpty() and tuples(again.resolved, "name", "id") == tuples(out.resolved, "name", "id")


def test_create_projects(table):
    out = create_projects(table("id long, name string", (1, "a")), table("request_id long, name string", (5, "b"), (4, "b"), (6, "a"), (7, "c")))
    assert tuples(out.created, "id", "name") == [(2, "b"), (3, "c")]
    assert tuples(out.conflicts, "request_id") == [(5,), (6,)]


def test_assign(catalog):
    out = assign_documents(catalog, document_ids=[1, 2, 3, 99], project_id=7)
    assert tuple(out.summary.first()) == (7, 3, 2, 1)
    assert tuples(out.members, "project_id", "document_id") == [(7, 1), (7, 2), (7, 3), (7, 9), (8, 2)]


def test_move_and_delete(catalog):
    moved = move_documents(catalog, document_ids=[1, 2, 3], target_folder_id=5)
    assert tuple(moved.summary.first()) == (3, 1, 2)
    assert dict(tuples(moved.documents, "id", "folder_id")) == {1: 5, 2: 5, 3: 5, 4: 6}
    root = move_documents(catalog, combine([with_ids([1, 4])]))
    assert tuple(root.summary.first()) == (2, 1, 1)
    dry = delete_documents(catalog, document_ids=[1, 2], dry_run=True)
    assert tuple(dry.summary.first()) == (2, True) and dry.documents.count() == 4
    gone = delete_documents(catalog, document_ids=[1, 2])
    assert tuples(gone.documents, "id") == [(3,), (4,)]
    twice = apply_delete_set(gone.documents, catalog.documents.where("id < 3").select("id"))
    assert tuples(twice, "id") == [(3,), (4,)]
    with pytest.raises(ValueError):
        move_documents(catalog)
