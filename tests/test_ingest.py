from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from docloom.operators import downloads
from docloom.operators import ingest as i
from docloom.plans.ingest import ingest_files, load_files

FILES = "path string, size long, md5 string, folder_id long"
HELD = "id long, name string, folder_id long, md5 string"


def files_of(table, count):
    return table(FILES, *[(f"f{n}.pdf", 1, f"m{n}", None) for n in range(count)])


def test_batches_and_keys(table):
    out = ingest_files(files_of(table, 5), table(HELD, (9, "x", None, "zz")), base_key="bulk-key", batch_size=2)
    assert tuples(out.batches, "batch_no", "batch_key", "files") == [
        (0, "bulk-key-0000", 2), (1, "bulk-key-0001", 2), (2, "bulk-key-0002", 1)]
    assert tuples(out.documents, "id", "name") == [(10 + n, f"f{n}.pdf") for n in range(5)]
    assert tuples(i.document_ids(out.outcomes)) == [(10 + n,) for n in range(5)]


@pytest.mark.parametrize("size", [0, 101])
def test_batch_size_limits(table, size):
    with pytest.raises(ValueError, match="batch_size"):
        i.plan_batches(files_of(table, 1), "k", order_by=["path"], batch_size=size)


def test_dense_ordinals_over_many_partitions(spark):
    files = spark.range(0, 5000, 1, 16).select(
        F.format_string("%08d", F.col("id") * 7919 % 5000).alias("path"))
    planned = i.plan_batches(files, "50%", order_by=["path"])
    bad = planned.where((F.col("path").cast("long") != F.col("ordinal")) | (F.col("batch_no") != F.floor(F.col("ordinal") / 100)))
    assert bad.isEmpty() and planned.count() == 5000
    assert planned.agg(F.max("batch_key")).first()[0] == "50%-0049"


def test_no_files(table):
    out = ingest_files(files_of(table, 0), table(HELD), base_key="k")
    assert tuple(i.outcome_summary(out.outcomes).first()) == (0, 0, 0, 0, 0)


def test_repeated_basenames_over_the_whole_set(table):
    files = table(FILES, ("a/same.pdf", 1, "x", None), ("b/same.pdf", 1, "y", None))
    with pytest.raises(ValueError, match="same.pdf"):
        ingest_files(files, table(HELD), base_key="k", batch_size=1)
    out = ingest_files(files, table(HELD), base_key="k", flatten=False)
    assert tuples(out.documents, "name") == [("a/same.pdf",), ("b/same.pdf",)]


def test_conflict_carries_the_id_and_too_large_none(table):
    files = table(FILES, ("dup.pdf", 1, "a", None), ("bad.pdf", 99, "b", None), ("ok.pdf", 1, "c", None))
    out = ingest_files(files, table(HELD, (7, "dup.pdf", None, "q"), (8, "ok.pdf", 3, "r")), base_key="k", max_size=50)
    got = {r["file_name"]: r for r in out.outcomes.collect()}
    assert (got["dup.pdf"]["document_id"], got["dup.pdf"]["error"]["code"]) == (7, "NAME_ALREADY_EXISTS")
    assert (got["bad.pdf"]["document_id"], got["bad.pdf"]["error"]["code"]) == (None, "FILE_TOO_LARGE")
    assert (got["bad.pdf"]["error"]["file_size"], got["bad.pdf"]["error"]["max_size"]) == (99, 50)
    assert got["ok.pdf"]["uploaded"] and got["ok.pdf"]["error"] is None  # unique per folder only
    assert i.outcome_summary(out.outcomes).first().asDict() == {
        "files": 3, "succeeded": 1, "failed": 2, "skipped": 0, "document_ids": 2}


@pytest.mark.parametrize(("policy", "uploaded", "skipped", "warned"), [
    ("allow", True, False, 0), ("notify", True, False, 1), ("block", False, True, 0)])
def test_duplicate_policies(table, policy, uploaded, skipped, warned):
    files = table(FILES, ("invoice.pdf", 1, "same", None))
    out = ingest_files(files, table(HELD, (42, "orig.pdf", None, "same")), base_key="k", on_duplicate=policy)
    row = out.outcomes.first()
    assert (row["uploaded"], row["skipped_as_duplicate"], row["duplicate_count"]) == (uploaded, skipped, 1)
    assert row["document_id"] == 43 and row["error"] is None
    assert tuples(out.duplicates, "document_id", "name") == [(42, "orig.pdf")]
    assert out.warnings.count() == warned and out.documents.count() == int(uploaded)
    summary = i.outcome_summary(out.outcomes).first()
    assert (summary["failed"], summary["skipped"], summary["document_ids"]) == (0, int(skipped), 1)


def test_places_are_unique_inside_the_set(table):
    files = table(FILES, ("x/b.pdf", 1, "m1", 7), ("y/b.pdf", 1, "m2", 7), ("z/b.pdf", 99, "m3", 7), ("v/b.pdf", 1, "dup", 7), ("w/b.pdf", 1, "m4", 8))
    held = table(HELD, (50, "other", 7, "dup"))
    out = ingest_files(files, held, base_key="k", max_size=50, on_duplicate="block", check_names=False)
    got = {r["path"]: (r["uploaded"], r["document_id"], r["error"] and r["error"]["code"], r["skipped_as_duplicate"]) for r in out.outcomes.collect()}
    assert got == {
        "v/b.pdf": (False, 51, None, True),  # a blocked duplicate takes no place
        "w/b.pdf": (True, 52, None, False),  # another folder
        "x/b.pdf": (True, 53, None, False),
        "y/b.pdf": (False, 53, "NAME_ALREADY_EXISTS", False),
        "z/b.pdf": (False, None, "FILE_TOO_LARGE", False),
    }
    assert tuples(out.documents, "id", "name", "folder_id") == [(52, "b.pdf", 8), (53, "b.pdf", 7)]


def test_layout_is_rebuilt_as_folders(table):
    folders = table("id long, name string, parent_id long", (1, "root", None), (2, "sub", 1))
    files = table(FILES, ("a.pdf", 1, "m1", None), ("sub/b.pdf", 1, "m2", None), ("sub/deep/b.pdf", 1, "m3", None), ("sub//deep/c.pdf", 1, "m4", None), ("sub/deep/./b.pdf", 1, "m5", None))
    held = table(HELD, (9, "b.pdf", 2, "q"))
    out = ingest_files(files, held, base_key="k", flatten=False, folders=folders, parent_id=1)
    assert tuples(out.created_folders, "id", "name", "parent_id") == sorted([(3, "deep", 2), (4, ".", 3)], key=repr)
    got = {r["path"]: (r["file_name"], r["folder_id"], r["uploaded"]) for r in out.outcomes.collect()}
    assert got == {
        "a.pdf": ("a.pdf", 1, True), "sub/b.pdf": ("b.pdf", 2, False), "sub/deep/b.pdf": ("b.pdf", 3, True),
        "sub//deep/c.pdf": ("c.pdf", 3, True), "sub/deep/./b.pdf": ("b.pdf", 4, True)}
    assert out.folders.count() == 4
    top = ingest_files(files, held, base_key="k", flatten=False, folders=folders)
    assert {r["path"]: r["folder_id"] for r in top.outcomes.collect()}["a.pdf"] is None


def test_a_failing_batch_stops_and_the_next_run_goes_on(spark, table, tmp_path):
    held = table(HELD, (9, "x", None, "zz"))
    files, out = files_of(table, 9), str(tmp_path / "out")
    broken = tmp_path / "broken"
    broken.write_text("")

    def transfer(batch):
        assert list(batch["ordinal"]) == sorted(batch["ordinal"])
        if broken.exists() and "f4.pdf" in set(batch["file_name"]):
            raise OSError("no route")

    options = {"base_key": "k", "batch_size": 2, "transfer": transfer, "project_id": 5, "tag_ids": [3, 4]}
    first = load_files(files, held, out, **options)
    assert tuple(first.progress.first()) == (2, 2, "OSError: no route", True)
    assert tuples(first.documents, "id") == [(10,), (11,), (12,), (13,)] and first.outcomes.count() == 4
    assert first.project_documents.count() == 4 and first.document_tags.count() == 8
    broken.unlink()
    second = load_files(files, held, out, **options)
    assert tuple(second.progress.first()) == (3, None, None, False)
    done = spark.read.parquet(out + "/documents")
    assert sorted(r["name"] for r in done.collect()) == [f"f{n}.pdf" for n in range(9)]
    assert done.select("id").distinct().count() == 9
    third = load_files(files, held, out, **options)
    assert third.documents.count() == 0 and tuple(third.progress.first())[0] == 0


def test_a_run_that_died_before_its_ledger_does_not_count(spark, table, tmp_path):
    out = str(tmp_path / "out")
    files_of(table, 1).select(F.lit(77).alias("id"), F.lit("ghost").alias("name")).write.parquet(out + "/documents/run=0")
    load_files(files_of(table, 3), table(HELD, (9, "x", None, "zz")), out, base_key="k")
    assert tuples(spark.read.parquet(out + "/documents"), "id") == [(10,), (11,), (12,)]


def test_unknown_policy(table):
    with pytest.raises(ValueError, match="on_duplicate"):
        ingest_files(files_of(table, 1), table(HELD), base_key="k", on_duplicate="ask")


def test_slot_without_file_fails_without_error(table):
    files = table("ordinal long, file_name string, size long, folder_id long, duplicate_count long, has_file boolean",
                  (0, "a", 1, None, 0, False))
    row = i.upload_outcomes(files, table(HELD), first_id=1).first()
    assert (row["uploaded"], row["error"], row["document_id"]) == (False, None, 1)
    assert i.outcome_summary(i.upload_outcomes(files, table(HELD), first_id=1)).first()["failed"] == 1


def test_rerun_resumes_after_the_ledger(table):
    held = table(HELD, (9, "x", None, "zz"))
    first = ingest_files(files_of(table, 5), held, base_key="k", batch_size=2)
    ledger = first.ledger.where("batch_key <> 'k-0002'")
    again = ingest_files(files_of(table, 5), held, base_key="k", batch_size=2, ledger=ledger)
    assert tuples(again.documents, "id", "name") == [(14, "f4.pdf")]
    changed = files_of(table, 5).withColumn("md5", F.concat("md5", F.lit("!")))
    other = ingest_files(changed, held, base_key="k", batch_size=2, ledger=ledger)
    assert tuples(other.conflicts, "batch_key") == [("k-0000",), ("k-0001",)]


def test_first_failure_stops_the_run(table):
    outcomes = table("batch_no long, document_id long", (0, 10), (1, 11), (2, 12))
    stopped = i.stop_at_first_failure(outcomes, table("batch_no long", (2,), (1,)))
    assert tuples(stopped.outcomes, "document_id") == [(10,)]
    assert tuple(stopped.progress.first()) == (1, True)
    fine = i.stop_at_first_failure(outcomes, table("batch_no long"))
    assert fine.outcomes.count() == 3 and tuple(fine.progress.first()) == (3, False)


def test_pins(table):
    outcomes = table("document_id long, uploaded boolean", (1, True), (2, False))
    assert tuples(i.pin_project(outcomes, 7), "project_id", "document_id") == [(7, 1)]
    assert tuples(i.tag_documents(outcomes, [3, 4]), "document_id", "tag_id") == [(1, 3), (1, 4)]
    assert i.tag_documents(outcomes, []).isEmpty()
    tags = table("batch_no long, tag_id long, name string", (0, 1, "old"), (1, 1, "new"), (0, 2, "b"))
    assert tuples(i.pin_tags(tags)) == [(1, "new"), (2, "b")]


def test_every_holder_of_a_content_is_a_member(table):
    held = table(HELD, *[(n, f"d{n}", None, "big" if n < 1500 else "small") for n in range(1502)])
    files = table("path string, md5 string", ("a", "big"), ("b", "small"), ("c", "none"))
    found = i.match_duplicates(files, held)
    assert dict(tuples(found.files, "path", "duplicate_count")) == {"a": 1500, "b": 2, "c": 0}
    assert tuples(found.members.where("md5 = 'big'"), "document_id") == sorted([(n,) for n in range(1500)], key=repr)
    assert found.members.count() == 1502


def test_repeated_names_error_counts_all(table):
    files = table("file_name string", *[(f"n{k:02}",) for k in range(30)] * 2)
    with pytest.raises(ValueError, match="30 .*repeated_names"):
        i.require_unique_names(files)


def test_ledger_written_twice_gives_one_conflict(table):
    planned = i.plan_batches(table("path string, file_name string, md5 string", ("a", "a", "1")), "k", order_by=["path"])
    ledger = table("batch_key string, payload_hash string", ("k-0000", "other"), ("k-0000", "other"))
    assert i.resume_from_ledger(planned, ledger).conflicts.count() == 1


def test_download_plan(table):
    docs = table("id long, name string", (1, "a/x.pdf"), (2, "b/x.pdf"), (3, ".."), (4, "have.pdf"), (5, "y"))
    there = table("name string", ("have.pdf",))
    plan = downloads.plan_downloads(docs, there)
    assert tuples(plan, "id", "target_name", "outcome") == sorted([
        (1, "x.pdf", "write"), (2, "x.pdf", "collision"), (3, None, "invalid"), (4, "have.pdf", "exists"),
        (5, "y", "write")], key=repr)
    over = downloads.plan_downloads(docs, there, overwrite=True)
    assert dict(tuples(over, "id", "outcome"))[4] == "write"
    assert tuples(downloads.missing_downloads(docs, there), "id") == [(1,), (5,)]
    named = docs.withColumn("mine", F.when(F.col("id") == 2, "custom.pdf"))
    assert dict(tuples(downloads.plan_downloads(named, override_col="mine"), "id", "target_name"))[2] == "custom.pdf"
