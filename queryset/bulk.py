"""Selection-driven changes (M)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import bulk as b
from docloom.operators import projects as p
from docloom.operators.selectors import combine, in_folder, named, of_class, paged_between
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql

_MOVE = combine([of_class(["en", "de"])], [named("doc9")])
_MOVE_WHERE = "document_class IN ('en', 'de') AND NOT contains(name, 'doc9')"


@query(
    "m1_move_documents",
    sql(f"SELECT id, CASE WHEN {_MOVE_WHERE} THEN 107 ELSE folder_id END AS folder_id FROM docs"),
)
def move_documents(spark: SparkSession, sf: str) -> DataFrame:
    moved = b.move_documents(t.catalog_of_docs(spark, sf), _MOVE, target_folder_id=107)
    return moved.documents.select("id", "folder_id")


@query(
    "m1_move_summary",
    sql(f"""SELECT count(*) AS matched, count(*) FILTER (WHERE folder_id <> 107) AS moved,
               count(*) FILTER (WHERE folder_id = 107) AS skipped FROM docs WHERE {_MOVE_WHERE}"""),
)
def move_summary(spark: SparkSession, sf: str) -> DataFrame:
    return b.move_documents(t.catalog_of_docs(spark, sf), _MOVE, target_folder_id=107).summary


@query(
    "m2_bulk_delete",
    sql("SELECT id, name FROM parts WHERE page_count > 10"),
)
def bulk_delete(spark: SparkSession, sf: str) -> DataFrame:
    kept = b.delete_documents(t.catalog_of_parts(spark, sf), combine([paged_between(high=10)]))
    return kept.documents.select("id", "name")


@query(
    "m2_bulk_delete_dry_run",
    sql("SELECT count(*) AS matched, true AS dry_run FROM parts WHERE page_count <= 10"),
)
def dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return b.delete_documents(
        t.catalog_of_parts(spark, sf), combine([paged_between(high=10)]), dry_run=True
    ).summary


@query(
    "m3_apply_delete_set",
    "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def delete_set(spark: SparkSession, sf: str) -> DataFrame:
    gone = t.load(spark, sf, "labels").where("toxic = 1").select("doc_id")
    once = b.apply_delete_set(t.docs(spark, sf).select("id"), gone)
    return b.apply_delete_set(once, gone)


_ASSIGN = combine([paged_between(low=20)])


@query(
    "m4_assign_documents",
    sql("""SELECT CAST(5 AS BIGINT) AS project_id, id AS document_id FROM parts
        WHERE page_count >= 20 AND id NOT IN
          (SELECT document_id FROM project_documents WHERE project_id = 5)"""),
)
def assign(spark: SparkSession, sf: str) -> DataFrame:
    out = p.assign_documents(t.catalog_of_parts(spark, sf), _ASSIGN, project_id=5)
    return out.added.select("project_id", "document_id")


@query(
    "m4_assign_summary",
    sql("""SELECT CAST(5 AS BIGINT) AS project_id, count(*) AS matched,
            count(*) FILTER (WHERE id NOT IN (SELECT document_id FROM project_documents WHERE project_id = 5)) AS added,
            count(*) FILTER (WHERE id IN (SELECT document_id FROM project_documents WHERE project_id = 5)) AS skipped
        FROM parts WHERE page_count >= 20"""),
)
def assign_summary(spark: SparkSession, sf: str) -> DataFrame:
    return p.assign_documents(t.catalog_of_parts(spark, sf), _ASSIGN, project_id=5).summary


@query(
    "m5_get_or_create_projects",
    """SELECT n.name, coalesce(s.id, (SELECT max(s_suppkey) FROM supplier) + f.rn) AS id, s.id IS NULL AS was_created
       FROM (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, 'Customer', 'Supplier')
                                  ELSE c_mktsegment END AS name FROM customer) n
       LEFT JOIN (SELECT s_name, min(s_suppkey) AS id FROM supplier GROUP BY 1) s ON s.s_name = n.name
       LEFT JOIN (SELECT name, row_number() OVER (ORDER BY name) AS rn FROM (
            SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, 'Customer', 'Supplier')
                                 ELSE c_mktsegment END AS name FROM customer)
            WHERE name NOT IN (SELECT s_name FROM supplier)) f ON f.name = n.name""",
)
def get_or_create(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    name = F.when(even, F.replace("c_name", F.lit("Customer"), F.lit("Supplier"))).otherwise(
        F.col("c_mktsegment")
    )
    wanted = t.load(spark, sf, "customer").select(name.alias("name"))
    return p.get_or_create_projects(t.projects(spark, sf), wanted).resolved


_WANTED = """(SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, 'Customer', 'Supplier')
                 ELSE c_mktsegment || (c_custkey % 50) END AS name FROM customer)"""


@query(
    "m6_project_create_conflicts",
    f"""SELECT request_id, name, 'NAME_ALREADY_EXISTS' AS code FROM (
          SELECT *, row_number() OVER (PARTITION BY name ORDER BY request_id) AS rn FROM {_WANTED})
        WHERE rn > 1 OR name IN (SELECT s_name FROM supplier)""",
)
def create_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return p.create_projects(t.projects(spark, sf), _create_set(spark, sf)).conflicts


@query(
    "m6_project_create_set",
    f"""SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY request_id) AS id, name
        FROM (SELECT name, min(request_id) AS request_id FROM {_WANTED}
              WHERE name NOT IN (SELECT s_name FROM supplier) GROUP BY 1)""",
)
def create_set(spark: SparkSession, sf: str) -> DataFrame:
    return p.create_projects(t.projects(spark, sf), _create_set(spark, sf)).created.select("id", "name")


def _create_set(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    other = F.concat("c_mktsegment", F.col("c_custkey") % 50)
    name = F.when(even, F.replace("c_name", F.lit("Customer"), F.lit("Supplier"))).otherwise(other)
    return t.load(spark, sf, "customer").select(F.col("c_custkey").alias("request_id"), name.alias("name"))


@query(
    "m1_move_documents_to_root",
    sql("SELECT id, CASE WHEN folder_id = 110 THEN NULL ELSE folder_id END AS folder_id FROM docs"),
)
def move_to_root(spark: SparkSession, sf: str) -> DataFrame:
    moved = b.move_documents(t.catalog_of_docs(spark, sf), combine([in_folder(110)]))
    return moved.documents.select("id", "folder_id")
