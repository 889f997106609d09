from __future__ import annotations

import json

import pytest
from conftest import tuples

from docloom.operators import selectors as s


@pytest.fixture()
def catalog(table):
    docs = table(
        "id long, name string, folder_id long, document_class string, file_size long, page_count long, "
        "is_valid boolean, has_active_workflow boolean, source_document long, created_at timestamp_ntz",
        (1, "Invoice draft", 1, "invoice", 10, 1, True, False, None, None),
        (2, "invoice final", 2, None, 20, 2, False, True, 1, None),
        (3, "receipt", 3, "receipt", 30, 3, None, None, None, None),
        (4, "note", None, "note", None, None, True, True, 1, None),
    )
    folders = table("id long, name string, parent_id long", (1, "a", None), (2, "b", 1), (3, "c", 2))
    tags = table("document_id long, tag_id long, tagged_at string", (1, 5, "2026-01-01"), (1, 6, "2026-02-01"), (3, 6, "2026-03-01"))
    tags = tags.withColumn("tagged_at", tags["tagged_at"].cast("timestamp"))
    members = table("project_id long, document_id long, created_at string", (7, 1, "2026-01-01"), (7, 2, "2026-01-05"))
    members = members.withColumn("created_at", members["created_at"].cast("timestamp"))
    jobs = table("job_id long, document_id long", (9, 2), (9, 2), (8, 3))
    return s.Catalog(docs, folders, None, tags, members, jobs)


def ids(frame):
    return [r[0] for r in tuples(frame, "id")]


@pytest.mark.parametrize(
    ("include", "exclude", "want"),
    [
        ([s.with_ids([1, 3, 99])], [], [1, 3]),
        ([s.with_ids([])], [], []),
        ([], [s.with_ids([])], [1, 2, 3, 4]),
        ([s.in_folder(2)], [], [2]),
        ([s.under_folder(1)], [], [1, 2, 3]),
        ([], [s.under_folder(2)], [1, 4]),
        ([s.named("INVOICE")], [], [1, 2]),
        ([s.of_class(["invoice", "note"])], [], [1, 4]),
        ([], [s.of_class(["invoice"])], [2, 3, 4]),
        ([s.tagged([6])], [], [1, 3]),
        ([s.tagged([5, 6], until="2026-01-15")], [], [1]),
        ([], [s.tagged([5])], [2, 3, 4]),
        ([s.sized_between(20, 30)], [], [2, 3]),
        ([], [s.sized_between(high=20)], [3, 4]),
        ([s.paged_between(low=2)], [], [2, 3]),
        ([s.split_from([1])], [], [2, 4]),
        ([s.in_project(7, "2026-01-05", "2026-01-05")], [], [2]),
        ([s.touched_by([9])], [], [2]),
        ([s.valid()], [], [1, 4]),
        ([], [s.valid()], [2, 3]),
        ([s.has_children()], [], [1]),
        ([s.running()], [], [2, 4]),
        ([s.classified()], [], [1, 3, 4]),
        ([], [s.classified()], [2]),
        ([s.named("invoice"), s.valid()], [s.in_folder(9)], [1]),
        ([], [], [1, 2, 3, 4]),
    ],
)
def test_selection(catalog, include, exclude, want):
    assert ids(s.select_documents(catalog, s.combine(include, exclude))) == want
    predicate = s.selection_predicate(catalog, s.combine(include, exclude))
    if predicate is not None:
        assert ids(catalog.documents.where(predicate)) == want


def test_shapes_match_the_stored_form():
    assert s.tagged([1], "2026-01-01") == {"type": "tagSelector", "tags": [1], "tagged_from": "2026-01-01"}
    assert s.in_project(3) == {"type": "projectSelector", "project_id": 3}
    assert s.created_between(until="x") == {"type": "createdAtSelector", "created_to": "x"}
    assert s.combine() == {"include": [], "exclude": []}


@pytest.mark.parametrize("make", [s.created_between, s.sized_between, s.paged_between])
def test_ranges_need_a_bound(make):
    with pytest.raises(ValueError):
        make()


def test_stored_ranges_need_a_bound_too(catalog):
    for kind in ("createdAtSelector", "sizeSelector", "pageCountSelector"):
        with pytest.raises(ValueError, match=kind):
            s.select_documents(catalog, {"include": [{"type": kind}]})


def test_shortcut_rules(catalog, table):
    with pytest.raises(ValueError, match="not both"):
        s.select_documents(catalog, s.combine(), document_ids=[1])
    with pytest.raises(ValueError):
        s.select_documents(catalog, required=True)
    assert ids(s.select_documents(catalog)) == [1, 2, 3, 4]
    assert ids(s.select_documents(catalog, document_ids=[], required=True)) == []
    assert ids(s.select_documents(catalog, document_ids=table("x long", (2,), (2,)), required=True)) == [2]


def test_id_lists_are_joined(catalog):
    assert ids(s.select_documents(catalog, document_ids=[1, 2, 3, 77])) == [1, 2, 3]


def test_json_round_trip_and_unknown_type(catalog):
    stored = json.dumps(s.combine([s.under_folder(1)], [s.named("draft")]))
    assert ids(s.select_documents(catalog, stored)) == [2, 3]
    with pytest.raises(ValueError, match="unknown selector"):
        s.select_documents(catalog, {"include": [{"type": "moodSelector"}]})


def test_missing_table_is_named(table):
    bare = s.Catalog(table("id long", (1,)))
    with pytest.raises(ValueError, match="document_tags"):
        s.select_documents(bare, s.combine([s.tagged([1])]))


def test_exact_names(catalog):
    exact = s.Matching("exact")
    assert ids(s.select_documents(catalog, s.combine([s.named("receipt")]), matching=exact)) == [3]
    assert ids(s.select_documents(catalog, s.combine([s.named("Receipt")]), matching=exact)) == []
