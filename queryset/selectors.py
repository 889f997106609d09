"""Selectors (P)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import selectors as s
from docloom.operators.folders import folder_paths
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql


def _over(catalog: Callable[[SparkSession, str], s.Catalog], selection: dict | str, **options):  # noqa: ANN202, ANN003
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return s.select_documents(catalog(spark, sf), selection, **options).select("id")

    return run


def _add(name: str, catalog, selection: dict | str, where: str, table: str, **options) -> None:  # noqa: ANN001, ANN003
    query(name, sql(f"SELECT id FROM {table} d WHERE {where}"))(_over(catalog, selection, **options))


def _labelled(spark: SparkSession, sf: str) -> s.Catalog:
    return t.catalog_of_docs(spark, sf, labels=True)


def _split_catalog(spark: SparkSession, sf: str) -> s.Catalog:
    return s.Catalog(t.splits(spark, sf))


_DOCS, _PARTS = t.catalog_of_docs, t.catalog_of_parts

_add("p1_file_selector", _DOCS, s.combine([s.with_ids([1, 5, 77, 150, 10**12])]),
     "id IN (1, 5, 77, 150, 1000000000000)", "docs")
_add("p2_folder_selector", _DOCS, s.combine([s.in_folder(105)]), "folder_id = 105", "docs")
_add("p3_folder_subtree_selector", _DOCS, s.combine([s.under_folder(2)]),
     "folder_id IN (SELECT descendant_id FROM closure WHERE ancestor_id = 2)", "docs")
_add("p4_name_contains", _PARTS, s.combine([s.named("Ring")]), "contains(lower(name), 'ring')", "parts")
_add("p4_name_exact", _PARTS, s.combine([s.named("small ring")]), "name = 'small ring'", "parts",
     matching=s.Matching("exact"))
_add("p5_document_class_selector", _DOCS, s.combine([s.of_class(["de", "fr"])]),
     "document_class IN ('de', 'fr')", "docs")
_add("p6_tag_selector", _PARTS, s.combine([s.tagged([2, 17])]),
     "id IN (SELECT document_id FROM document_tags WHERE tag_id IN (2, 17))", "parts")
_add("p6_tag_selector_dated", _PARTS,
     s.combine([s.tagged([2, 3, 17], "1995-02-01T00:00:00Z", "1996-12-31T00:00:00Z")]),
     """id IN (SELECT document_id FROM document_tags WHERE tag_id IN (2, 3, 17)
        AND tagged_at BETWEEN TIMESTAMP '1995-02-01' AND TIMESTAMP '1996-12-31')""", "parts")
_add("p7_created_at_selector", _DOCS,
     s.combine([s.created_between("2024-01-01T01:00:00Z", "2024-01-01T10:00:00Z")]),
     "created_at BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 10:00:00'", "docs")
_add("p8_size_selector", _DOCS, s.combine([s.sized_between(1000, 5000)]),
     "file_size BETWEEN 1000 AND 5000", "docs")
_add("p9_page_count_selector", _PARTS, s.combine([s.paged_between(high=10)]), "page_count <= 10", "parts")
_add("p10_source_document_selector", _split_catalog, s.combine([s.split_from([1, 2, 30])]),
     "source_document IN (1, 2, 30)", "splits")
_add("p11_project_selector", _PARTS,
     s.combine([s.in_project(7, "1995-01-01T00:00:00Z", "1998-12-31T00:00:00Z")]),
     """id IN (SELECT document_id FROM project_documents WHERE project_id = 7
        AND created_at BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1998-12-31')""", "parts")
_add("p12_job_selector", _PARTS, s.combine([s.touched_by([1, 2, 3, 100])]),
     "id IN (SELECT document_id FROM job_documents WHERE job_id IN (1, 2, 3, 100))", "parts")
_add("p13_is_valid_selector", _labelled, s.combine([s.valid()]), "is_valid", "docs")
_add("p13_is_invalid", _labelled, s.combine(exclude=[s.valid()]), "NOT is_valid", "docs")
_add("p14_has_children_selector", _split_catalog, s.combine([s.has_children()]),
     "id IN (SELECT source_document FROM splits WHERE source_document IS NOT NULL)", "splits")
_add("p15_running_workflow_selector", _labelled, s.combine([s.running()]), "has_active_workflow", "docs")
_add("p17_combine", _labelled,
     s.combine([s.of_class(["en", "fr"]), s.sized_between(low=500)], [s.named("doc1"), s.valid()]),
     """document_class IN ('en', 'fr') AND file_size >= 500 AND NOT contains(name, 'doc1')
        AND NOT is_valid""", "docs")
_add("p17_exclude_joined", _PARTS,
     s.combine([s.paged_between(low=5)], [s.tagged([1, 2, 3]), s.in_project(4)]),
     """page_count >= 5 AND id NOT IN (SELECT document_id FROM document_tags WHERE tag_id IN (1, 2, 3))
        AND id NOT IN (SELECT document_id FROM project_documents WHERE project_id = 4)""", "parts")
_add("p19_compile_json", _PARTS,
     '{"include": [{"type": "pageCountSelector", "page_count_from": 3, "page_count_to": 30},'
     ' {"type": "jobSelector", "jobs": [5, 6, 7, 8, 9]}], "exclude": [{"type": "nameSelector", "name": "red"}]}',
     """page_count BETWEEN 3 AND 30 AND NOT contains(name, 'red')
        AND id IN (SELECT document_id FROM job_documents WHERE job_id BETWEEN 5 AND 9)""", "parts")


@query(
    "p3_folder_subtree_from_paths",
    sql("""SELECT id FROM docs WHERE folder_id IN
           (SELECT descendant_id FROM closure WHERE ancestor_id = 4)"""),
)
def subtree_from_paths(spark: SparkSession, sf: str) -> DataFrame:
    paths = folder_paths(t.folders(spark, sf))
    catalog = s.Catalog(t.docs(spark, sf), folder_paths=paths)
    return s.select_documents(catalog, s.combine([s.under_folder(4)])).select("id")


def _some_unclassified(spark: SparkSession, sf: str) -> s.Catalog:
    documents = t.docs(spark, sf).withColumn(
        "document_class", F.when(F.col("document_class") != "es", F.col("document_class"))
    )
    return s.Catalog(documents)


_add("p16_has_classification_selector", _some_unclassified, s.combine([s.classified()]),
     "document_class <> 'es'", "docs")
_add("p16_unclassified", _some_unclassified, s.combine(exclude=[s.classified()]),
     "document_class = 'es'", "docs")
_add("p17_null_safe_exclusion", _some_unclassified, s.combine(exclude=[s.of_class(["en"])]),
     "document_class <> 'en'", "docs")


@query("p18_document_ids_shortcut", "SELECT doc_id AS id FROM documents WHERE doc_id IN (3, 4, 5)")
def shortcut(spark: SparkSession, sf: str) -> DataFrame:
    return s.select_documents(_DOCS(spark, sf), document_ids=[3, 4, 5], required=True).select("id")


@query(
    "p18_document_ids_table",
    "SELECT doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def shortcut_table(spark: SparkSession, sf: str) -> DataFrame:
    good = t.load(spark, sf, "labels").where("quality = 1").select("doc_id")
    return s.select_documents(_DOCS(spark, sf), document_ids=good, required=True).select("id")
