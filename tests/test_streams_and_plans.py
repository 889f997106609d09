from __future__ import annotations

import datetime
import hashlib
import json
import os

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from docloom.operators.extraction import ExtractRule
from docloom.operators.jobs import BudgetExceeded
from docloom.operators.selectors import Catalog, combine, named
from docloom.plans.extract import ExtractionFailed, extract, uncovered_files
from docloom.streaming import combine as combining
from docloom.streaming.combine import earliest_rows
from docloom.streaming.ingest import ingest_stream
from docloom.streaming.replay import first_requests_stream
from docloom.streaming.status import completion_stream, unknown_status_stream

NOON = datetime.datetime(2026, 1, 1, 12)


def write_events(folder, name, *rows):
    """rows: (subject, status, seconds after noon); every wait starts at noon."""
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"subject_id": s, "status": status, "started_at": NOON.isoformat() + "Z",
                    "ts": (NOON + datetime.timedelta(seconds=sec)).isoformat() + "Z"})
        for s, status, sec in rows
    ]
    (folder / name).write_text("\n".join(lines))
    # The file source takes files by time; give each its own second.
    second = 1_700_000_000 + int(name.split(".")[0])
    os.utime(folder / name, (second, second))


def read_events(spark, folder):
    schema = "subject_id long, status string, ts timestamp, started_at timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def drain(stream, root):
    running = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True).start(f"{root}/table")
    )
    running.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/table")


def test_completion_emits_once_and_times_out(spark, tmp_path):
    inbox = tmp_path / "in"
    write_events(inbox, "1.json", (1, "running", 0), (2, "running", 0), (3, "queued", 1), (4, "completed", 1800), (5, "failed", 1801))
    write_events(inbox, "2.json", (1, "completed", 60), (1, "completed", 70))
    write_events(inbox, "3.json", (1, "failed", 90), (9, "running", 9000))
    write_events(inbox, "4.json", (2, "completed", 9100), (9, "completed", 9200))
    ended = completion_stream(read_events(spark, inbox), watermark="10 seconds")
    got = drain(ended, tmp_path / "out")
    assert tuples(got, "subject_id", "outcome", "status") == sorted(
        [(1, "done", "completed"), (2, "timeout", None), (3, "timeout", None), (4, "done", "completed"),
         (5, "timeout", None), (9, "timeout", None)], key=repr)


def test_completion_without_deadline(spark, tmp_path):
    inbox = tmp_path / "in"
    write_events(inbox, "1.json", (1, "running", 0), (2, "running", 0))
    write_events(inbox, "2.json", (1, "completed", 99_000))
    ended = completion_stream(read_events(spark, inbox), watermark="10 seconds", max_wait_seconds=None)
    assert tuples(drain(ended, tmp_path / "out"), "subject_id", "outcome") == [(1, "done")]


def test_unknown_status_once(spark, tmp_path):
    inbox = tmp_path / "in"
    write_events(inbox, "1.json", (1, "queued", 0), (1, "queued", 1), (1, "running", 2), (2, "queued", 3))
    write_events(inbox, "2.json", (1, "queued", 4), (1, "paused", 5))
    got = drain(unknown_status_stream(read_events(spark, inbox), watermark="1 hour"), tmp_path / "out")
    assert tuples(got) == [(1, "paused"), (1, "queued"), (2, "queued")]


def test_first_requests(spark, tmp_path):
    inbox = tmp_path / "in"
    write_events(inbox, "1.json", (1, "a", 0), (2, "b", 1))
    write_events(inbox, "2.json", (1, "c", 2), (3, "d", 3))
    stream = first_requests_stream(read_events(spark, inbox), key="subject_id", retention="1 hour")
    assert tuples(drain(stream, tmp_path / "out"), "subject_id", "status") == [(1, "a"), (2, "b"), (3, "d")]


def test_streams_take_the_earliest_of_unordered_rows(spark, tmp_path):
    """Out-of-order rows inside a file, several micro-batches: as the batch forms say."""
    inbox = tmp_path / "in"
    for part in range(3):
        minutes = [(7 * n) % 50 for n in range(50)]
        write_events(inbox, f"{part}.json", *[(s, "completed", 500 * part + m) for m in minutes for s in (1, 2 + part)])
    events = read_events(spark, inbox)
    ended = drain(completion_stream(events, watermark="10 days"), tmp_path / "ended")
    first = {r["subject_id"]: r["ended_at"] for r in ended.collect()}
    replayed = drain(first_requests_stream(events, key="subject_id", retention="10 days"), tmp_path / "requests")
    taken = {r["subject_id"]: r["ts"] for r in replayed.collect()}
    earliest = {r["subject_id"]: r["ts"] for r in spark.read.schema(events.schema).json(str(inbox)).groupBy("subject_id").agg(F.min("ts").alias("ts")).collect()}
    assert first == taken == earliest


def test_a_hot_key_reaches_its_state_as_one_row_per_task(spark, table, tmp_path, monkeypatch):
    rows = [(7 if n % 3 else n, n % 4, None if n == 9 else NOON + datetime.timedelta(seconds=(n * 31) % 997)) for n in range(1, 900)]
    rows += [(None, 5, NOON), (None, 4, NOON)]
    frame = table("subject_id long, request_id long, ts timestamp", *rows).repartition(6)
    found = earliest_rows(frame.withColumn("at", F.col("ts")), "subject_id", ["ts", "request_id"], "at")
    assert found.groupBy("subject_id").count().agg(F.max("count")).first()[0] <= 6
    order = F.struct("ts", "request_id")
    best = found.groupBy("subject_id").agg(F.min(order).alias("first"), F.max("at").alias("last"))
    plain = frame.where("ts is not null").groupBy("subject_id").agg(F.min(order).alias("first"), F.max("ts").alias("last"))
    assert sorted(best.collect(), key=repr) == sorted(plain.collect(), key=repr)
    monkeypatch.setattr(combining, "MOST_KEYS", 10)
    assert earliest_rows(frame, "subject_id", ["request_id"], "ts").select("subject_id").distinct().count() == frame.where("ts is not null").select("subject_id").distinct().count()


def test_arriving_files_are_loaded_once(spark, table, tmp_path):
    inbox, out = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()
    held = table("id long, name string, folder_id long, md5 string", (7, "taken.txt", None, "x"))
    counts = []

    def run():
        ingest_stream(spark, str(inbox), held, str(out), base_key="live", on_duplicate="block",
                      on_batch=lambda df: counts.extend(r.asDict() for r in df.collect())).awaitTermination()
        return spark.read.parquet(str(out / "outcomes"))

    (inbox / "a.txt").write_text("one")
    (inbox / "taken.txt").write_text("two")
    assert tuples(run(), "file_name", "document_id", "uploaded") == [("a.txt", 8, True), ("taken.txt", 7, False)]
    (inbox / "b.txt").write_text("one")
    (inbox / "a2.txt").write_text("three")
    got = {r["file_name"]: r for r in run().collect()}
    assert got["b.txt"]["skipped_as_duplicate"] and got["a2.txt"]["uploaded"]
    assert len({r["document_id"] for r in got.values()}) == 4
    (inbox / "z.txt").write_text("four")
    last = {r["file_name"]: r["document_id"] for r in run().collect()}
    assert len(set(last.values())) == 5 and last["z.txt"] == max(last.values())
    assert [(c["batch_key"], c["succeeded"], c["skipped"]) for c in counts[:2]] == [("live-0-0000", 1, 0), ("live-1-0000", 1, 1)]


@pytest.mark.parametrize("flatten", [True, False])
def test_repeated_names_are_outcomes_and_do_not_stop_the_stream(spark, table, tmp_path, flatten):
    inbox, out = tmp_path / "in", tmp_path / "out"
    held = table("id long, name string, folder_id long, md5 string", (7, "taken.txt", None, "x"))
    for name in ("a/x.txt", "b/x.txt", "_hidden.txt", "sub dir/y.txt"):
        (inbox / name).parent.mkdir(parents=True, exist_ok=True)
        (inbox / name).write_text(name)

    def run():
        ingest_stream(spark, str(inbox), held, str(out), base_key="live", flatten=flatten).awaitTermination()
        return {r["path"].split("/in/")[1]: r for r in spark.read.parquet(str(out / "outcomes")).collect()}

    got = run()
    assert {n: r["uploaded"] for n, r in got.items()} == {"a/x.txt": True, "b/x.txt": not flatten, "sub dir/y.txt": True}
    assert got["a/x.txt"]["md5"] == hashlib.md5(b"a/x.txt").hexdigest()
    if flatten:
        assert got["b/x.txt"]["error"]["code"] == "NAME_ALREADY_EXISTS" and got["b/x.txt"]["document_id"] == got["a/x.txt"]["document_id"]
    (inbox / "c").mkdir()
    (inbox / "c/x.txt").write_text("again")
    (inbox / "c/taken.txt").write_text("mine")
    later = run()
    assert later["c/x.txt"]["uploaded"] is not flatten and later["c/taken.txt"]["uploaded"] is not flatten
    ids = [r["document_id"] for r in later.values() if r["uploaded"]]
    assert len(set(ids)) == len(ids)


RULES = [ExtractRule(5, "Total", "Number", r"total=([0-9.]+)", 1), ExtractRule(6, "Vendor", "String", r"by ([a-z]+)", 1)]


@pytest.fixture()
def catalog(table):
    return Catalog(table(
        "id long, name string, folder_id long, md5 string, page_count long, status string, text string",
        (1, "a.txt", None, "m1", 2, "ready", "total=1234.50 by acme"), (2, "b.txt", None, "m2", 1, "ready", None),
        (3, "c.txt", None, "m3", 1, "processing", "total=9")))


FILES = "path string, size long, md5 string, folder_id long, text string"


def test_extract_from_ids(catalog):
    out = extract(catalog, RULES, document_ids=[1])
    assert out.outcomes is None
    assert tuples(out.values, "document_id", "field_key", "value") == [(1, "Total", "1234.5"), (1, "Vendor", "acme")]
    assert out.job.first()["status"] == "completed" and out.job.first()["credits"] == 4


def test_extract_partial_failed_and_not_ready(catalog):
    out = extract(catalog, RULES, selectors=combine(exclude=[named("c")]))
    assert (out.job.first()["status"], out.job.first()["error_count"]) == ("partial_success", 1)
    with pytest.raises(ExtractionFailed, match="failed"):
        extract(catalog, RULES, document_ids=[2])
    out = extract(catalog, RULES, document_ids=[2], raise_on_failure=False)
    assert out.job.first()["status"] == "failed" and tuples(out.values, "document_id", "field_key") == [(2, None)]
    with pytest.raises(ExtractionFailed, match="ready"):
        extract(catalog, RULES, document_ids=[1, 3])


def test_extract_joins_answers_not_texts(catalog):
    out = extract(catalog, RULES, document_ids=[1, 2])
    assert tuples(out.values, "document_id", "value") == sorted(
        [(1, "1234.5"), (1, "acme"), (2, None)], key=repr)


def test_extract_budget(catalog):
    with pytest.raises(BudgetExceeded):
        extract(catalog, RULES, document_ids=[1], max_credits=3)
    assert extract(catalog, RULES, document_ids=[1], max_credits=4).job.count() == 1


def test_extract_from_files(catalog, table):
    files = table(FILES, ("in/new.txt", 10, "n1", None, "total=7 by z"), ("in/a.txt", 10, "n2", None, "total=99"))
    projects = table("id long, name string", (5, "Bulk"))
    out = extract(catalog, RULES, files=files, project_name="Bulk", projects=projects)
    # The rejected file's id is the document that has its name: it is extracted too.
    assert tuples(out.values, "document_id", "field_key", "value") == [
        (1, "Total", "1234.5"), (1, "Vendor", "acme"), (5, "Total", "7"), (5, "Vendor", "z")]
    assert tuples(out.project_documents, "project_id", "document_id") == [(5, 5)]
    assert tuples(uncovered_files(out.outcomes, out.values), "file_name", "reason") == [("a.txt", "NAME_ALREADY_EXISTS")]


def test_extract_stops_when_every_file_is_rejected(catalog, table):
    files = table(FILES, ("bad.txt", 10, "n1", None, "x"))
    with pytest.raises(ExtractionFailed, match="every file"):
        extract(catalog, RULES, files=files, max_size=5)


def test_extract_arguments(catalog, table):
    with pytest.raises(ValueError, match="exactly one"):
        extract(catalog, RULES)
    with pytest.raises(ValueError, match="exactly one"):
        extract(catalog, RULES, document_ids=[1], selectors=combine())
    with pytest.raises(ValueError, match="project_name needs files"):
        extract(catalog, RULES, document_ids=[1], project_name="P")


def state_rows(stream, root) -> int:
    running = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True).start(f"{root}/table")
    )
    running.awaitTermination()
    return max(p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"])


@pytest.mark.parametrize("form", ["completions", "requests"])
def test_many_keys_share_few_calls_of_the_step(spark, tmp_path, monkeypatch, form):
    """A call costs milliseconds; buckets, not keys, bound the calls and the rows of state."""
    monkeypatch.setattr(combining, "BUCKETS", 5)
    inbox = tmp_path / "in"
    write_events(inbox, "1.json", *[(s, "completed", s or 0) for s in [*range(60), None]])
    events = read_events(spark, inbox)
    stream = completion_stream(events) if form == "completions" else first_requests_stream(events, key="subject_id")
    assert state_rows(stream, tmp_path / "out") <= 6
    got = spark.read.parquet(str(tmp_path / "out/table"))
    assert tuples(got, "subject_id") == sorted([(s,) for s in [*range(60), None]], key=repr)


def test_keys_of_one_bucket_keep_their_own_waits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(combining, "BUCKETS", 1)
    others = (test_completion_emits_once_and_times_out, test_completion_without_deadline, test_first_requests,
              test_streams_take_the_earliest_of_unordered_rows)
    for number, other in enumerate(others):
        (tmp_path / str(number)).mkdir()
        other(spark, tmp_path / str(number))


def test_an_answered_key_is_forgotten_by_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(combining, "BUCKETS", 1)
    inbox, big = tmp_path / "in", 2**60 + 1
    write_events(inbox, "1.json", (big, "a", 0), (2, "b", 3000), (None, "n", 3000))
    write_events(inbox, "2.json", (2, "c", 9000), (None, "m", 9000))
    write_events(inbox, "3.json", (9, "x", 9001))
    write_events(inbox, "4.json", (big, "d", 9002), (2, "e", 9003))
    stream = first_requests_stream(read_events(spark, inbox), key="subject_id", retention="1 hour")
    got = drain(stream, tmp_path / "out")
    assert tuples(got, "subject_id", "status") == sorted([(big, "a"), (2, "b"), (None, "n"), (9, "x"), (big, "d")], key=repr)
