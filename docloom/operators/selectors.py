"""Document selectors: 16 predicate kinds, combined as include-AND / exclude-NOT.

A selector is a plain dict with a ``type`` tag, so one stored as JSON on a job
can be compiled again.  Each compiles to a column predicate, which Spark pushes
to the scan, or to a set of document ids, which becomes a semi or anti join.
Spark picks the join strategy from the size of the id set; nothing is broadcast
by hint.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.folders import subtree_ids

Selector = dict[str, Any]


@dataclass(frozen=True)
class Catalog:
    """The tables selectors may look at; only ``documents`` is always needed.

    ``folder_paths`` is the optional output of ``folder_paths()``: with it, a
    subtree selector is one scan, without it the tree is walked level by level.
    """

    documents: DataFrame
    folders: DataFrame | None = None
    folder_paths: DataFrame | None = None
    document_tags: DataFrame | None = None
    project_documents: DataFrame | None = None
    job_documents: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        found = getattr(self, name)
        if found is None:
            raise ValueError(f"this selector needs the {name} table in the catalog")
        return found


# ----- constructors ------------------------------------------------------------


def _drop_unset(selector: Selector) -> Selector:
    return {key: value for key, value in selector.items() if value is not None}


def _ranged(kind: str, low_key: str, low: Any, high_key: str, high: Any) -> Selector:
    if low is None and high is None:
        raise ValueError(f"{kind} needs {low_key} and/or {high_key}")
    return _drop_unset({"type": kind, low_key: low, high_key: high})


def with_ids(ids: Iterable[int]) -> Selector:
    return {"type": "fileSelector", "files": list(ids)}


def in_folder(folder_id: int) -> Selector:
    return {"type": "folderSelector", "folder_id": folder_id}


def under_folder(folder_id: int) -> Selector:
    return {"type": "folderSubtreeSelector", "folder_id": folder_id}


def named(name: str) -> Selector:
    return {"type": "nameSelector", "name": name}


def of_class(classes: Iterable[str]) -> Selector:
    return {"type": "documentClassSelector", "classes": list(classes)}


def tagged(tags: Iterable[int], since: str | None = None, until: str | None = None) -> Selector:
    return _drop_unset(
        {"type": "tagSelector", "tags": list(tags), "tagged_from": since, "tagged_to": until}
    )


def created_between(since: str | None = None, until: str | None = None) -> Selector:
    return _ranged("createdAtSelector", "created_from", since, "created_to", until)


def sized_between(low: int | None = None, high: int | None = None) -> Selector:
    return _ranged("sizeSelector", "size_from", low, "size_to", high)


def paged_between(low: int | None = None, high: int | None = None) -> Selector:
    return _ranged("pageCountSelector", "page_count_from", low, "page_count_to", high)


def split_from(sources: Iterable[int]) -> Selector:
    return {"type": "sourceDocumentSelector", "source_documents": list(sources)}


def in_project(project_id: int, since: str | None = None, until: str | None = None) -> Selector:
    return _drop_unset(
        {
            "type": "projectSelector",
            "project_id": project_id,
            "added_from": since,
            "added_to": until,
        }
    )


def touched_by(jobs: Iterable[int]) -> Selector:
    return {"type": "jobSelector", "jobs": list(jobs)}


def valid() -> Selector:
    return {"type": "isValidSelector"}


def has_children() -> Selector:
    return {"type": "hasChildrenSelector"}


def running() -> Selector:
    return {"type": "hasRunningWorkflowSelector"}


def classified() -> Selector:
    return {"type": "hasClassificationSelector"}


def combine(
    include: Iterable[Selector] | None = None, exclude: Iterable[Selector] | None = None
) -> dict[str, list[Selector]]:
    """``include`` selectors must all match; no ``exclude`` selector may match."""
    return {"include": list(include or ()), "exclude": list(exclude or ())}


def target_selection(
    selectors: dict[str, Any] | str | None,
    document_ids: Sequence[int] | DataFrame | None,
    *,
    required: bool,
) -> dict[str, Any] | None:
    """One selection out of the two ways to give it; an empty id list is given."""
    if document_ids is not None:
        if selectors is not None:
            raise ValueError("give selectors or document_ids, not both")
        files = document_ids if isinstance(document_ids, DataFrame) else list(document_ids)
        return combine(include=[{"type": "fileSelector", "files": files}])
    if selectors is None:
        if required:
            raise ValueError("give selectors or document_ids")
        return None
    return parse_selection(selectors)


def parse_selection(selection: dict[str, Any] | str) -> dict[str, list[Selector]]:
    """Read a selection from a dict or its JSON text; unknown types are errors."""
    loaded = json.loads(selection) if isinstance(selection, str) else selection
    parsed = combine(loaded.get("include"), loaded.get("exclude"))
    for selector in parsed["include"] + parsed["exclude"]:
        if selector.get("type") not in _COMPILERS:
            raise ValueError(f"unknown selector type {selector.get('type')!r}")
    return parsed


# ----- compilation -------------------------------------------------------------


@dataclass(frozen=True)
class Matching:
    """How names are compared: ``contains`` or ``exact``."""

    name_mode: str = "contains"

    def name_predicate(self, column: Column, wanted: str) -> Column:
        if self.name_mode == "exact":
            return column == F.lit(wanted)
        if self.name_mode == "contains":
            return F.contains(F.lower(column), F.lower(F.lit(wanted)))
        raise ValueError(f"unknown name match mode {self.name_mode!r}")


def _within(column: Column, low: Any, high: Any) -> Column:
    """Inclusive range with open ends."""
    bounds = []
    if low is not None:
        bounds.append(column >= low)
    if high is not None:
        bounds.append(column <= high)
    if not bounds:
        return F.lit(True)
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def _instant(text: str | None) -> Column | None:
    return None if text is None else F.lit(text).cast("timestamp")


def _member(column: Column, values: Sequence[Any]) -> Column:
    return column.isin(*values) if values else F.lit(False)


def _id_set(documents: DataFrame, files: Sequence[int] | DataFrame) -> Column | DataFrame:
    if isinstance(files, DataFrame):
        return _ids(files.select(F.col(files.columns[0]).cast("long").alias("document_id")))
    return documents.sparkSession.createDataFrame([(i,) for i in sorted(set(files))], "document_id long")


def _range_of(selector: Selector, kind: str, column: str, low: str, high: str) -> Column:
    if selector.get(low) is None and selector.get(high) is None:
        raise ValueError(f"{kind} needs {low} and/or {high}")
    return _within(F.col(column), selector.get(low), selector.get(high))


def _created(selector: Selector, catalog: Catalog, how: Matching) -> Column:
    low, high = selector.get("created_from"), selector.get("created_to")
    if low is None and high is None:
        raise ValueError("createdAtSelector needs created_from and/or created_to")
    return _within(F.col("created_at"), _instant(low), _instant(high))


def _ids(members: DataFrame) -> DataFrame:
    """Distinct ids: combined before the shuffle that the join needs anyway.

    A semi join cannot split a hot key on its right side, so the repeats of a
    document go before they get there.
    """
    return members.select("document_id").distinct()


def _tagged(selector: Selector, catalog: Catalog, how: Matching) -> DataFrame:
    tags = catalog.table("document_tags").where(_member(F.col("tag_id"), selector["tags"]))
    low, high = _instant(selector.get("tagged_from")), _instant(selector.get("tagged_to"))
    return _ids(tags.where(_within(F.col("tagged_at"), low, high)))


def _in_project(selector: Selector, catalog: Catalog, how: Matching) -> DataFrame:
    members = catalog.table("project_documents").where(
        F.col("project_id") == selector["project_id"]
    )
    low, high = _instant(selector.get("added_from")), _instant(selector.get("added_to"))
    return _ids(members.where(_within(F.col("created_at"), low, high)))


def _touched(selector: Selector, catalog: Catalog, how: Matching) -> DataFrame:
    return _ids(catalog.table("job_documents").where(_member(F.col("job_id"), selector["jobs"])))


def _under_folder(selector: Selector, catalog: Catalog, how: Matching) -> tuple[str, DataFrame]:
    root = selector["folder_id"]
    if catalog.folder_paths is not None:
        inside = catalog.folder_paths.where(F.array_contains("path_ids", F.lit(root).cast("long")))
        return "folder_id", inside.select("id")
    return "folder_id", subtree_ids(catalog.table("folders"), [root])


def _has_children(selector: Selector, catalog: Catalog, how: Matching) -> DataFrame:
    sources = catalog.documents.where(F.col("source_document").isNotNull())
    return sources.select(F.col("source_document").alias("document_id")).distinct()


_Compiled = Column | DataFrame | tuple[str, DataFrame]

_COMPILERS: dict[str, Callable[[Selector, Catalog, Matching], _Compiled]] = {
    "fileSelector": lambda s, c, m: _id_set(c.documents, s["files"]),
    "folderSelector": lambda s, c, m: F.col("folder_id") == s["folder_id"],
    "folderSubtreeSelector": _under_folder,
    "nameSelector": lambda s, c, m: m.name_predicate(F.col("name"), s["name"]),
    "documentClassSelector": lambda s, c, m: _member(F.col("document_class"), s["classes"]),
    "tagSelector": _tagged,
    "createdAtSelector": _created,
    "sizeSelector": lambda s, c, m: _range_of(
        s, "sizeSelector", "file_size", "size_from", "size_to"
    ),
    "pageCountSelector": lambda s, c, m: _range_of(
        s, "pageCountSelector", "page_count", "page_count_from", "page_count_to"
    ),
    "sourceDocumentSelector": lambda s, c, m: _member(
        F.col("source_document"), s["source_documents"]
    ),
    "projectSelector": _in_project,
    "jobSelector": _touched,
    "isValidSelector": lambda s, c, m: F.col("is_valid"),
    "hasChildrenSelector": _has_children,
    "hasRunningWorkflowSelector": lambda s, c, m: F.col("has_active_workflow"),
    "hasClassificationSelector": lambda s, c, m: F.col("document_class").isNotNull(),
}


def _matches(compiled: Column, keep: bool) -> Column:
    # A null answer means "does not match", also under NOT.
    return compiled if keep else ~F.coalesce(compiled, F.lit(False))


def _apply(documents: DataFrame, compiled: _Compiled, keep: bool) -> DataFrame:
    if isinstance(compiled, Column):
        return documents.where(_matches(compiled, keep))
    key, members = compiled if isinstance(compiled, tuple) else ("id", compiled)
    members = members.toDF("__member")
    how = "left_semi" if keep else "left_anti"
    return documents.join(members, documents[key] == members["__member"], how)


def _compile(
    catalog: Catalog, selection: dict[str, list[Selector]], matching: Matching
) -> list[tuple[_Compiled, bool]]:
    """Column predicates first, so that each join sees as few rows as possible."""
    steps = [
        (_COMPILERS[selector["type"]](selector, catalog, matching), keep)
        for part, keep in (("include", True), ("exclude", False))
        for selector in selection[part]
    ]
    return sorted(steps, key=lambda step: not isinstance(step[0], Column))


#: Kinds that look at nothing but the document's own row.
_JOINED = {
    "fileSelector",
    "folderSubtreeSelector",
    "tagSelector",
    "projectSelector",
    "jobSelector",
    "hasChildrenSelector",
}


def selection_predicate(
    catalog: Catalog,
    selectors: dict[str, Any] | str | None = None,
    *,
    document_ids: Sequence[int] | DataFrame | None = None,
    matching: Matching = Matching(),
) -> Column | None:
    """The selection as one column predicate, or None when it needs a join."""
    selection = target_selection(selectors, document_ids, required=True)
    for selector in selection["include"] + selection["exclude"]:
        if selector["type"] in _JOINED:
            return None
    predicate = F.lit(True)
    for compiled, keep in _compile(catalog, selection, matching):
        predicate = predicate & _matches(compiled, keep)
    return predicate


def select_documents(
    catalog: Catalog,
    selectors: dict[str, Any] | str | None = None,
    *,
    document_ids: Sequence[int] | DataFrame | None = None,
    required: bool = False,
    matching: Matching = Matching(),
) -> DataFrame:
    """The catalog's documents that a selection matches, each at most once.

    Without a selection (or with an empty one) every document matches; an empty
    ``document_ids`` list matches none.
    """
    selection = target_selection(selectors, document_ids, required=required)
    documents = catalog.documents
    if selection is None:
        return documents
    for compiled, keep in _compile(catalog, selection, matching):
        documents = _apply(documents, compiled, keep)
    return documents
