"""Search, paging, lookup (Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import search as q
from docloom.operators.selectors import combine, of_class, select_documents
from docloom.session import materialize
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql


@query(
    "q1_search_page",
    sql("""SELECT id, name, file_size, (SELECT count(*) FROM docs WHERE document_class = 'en') > 40 AS has_more
        FROM docs WHERE document_class = 'en' ORDER BY file_size DESC, id LIMIT 20 OFFSET 20"""),
)
def search_page(spark: SparkSession, sf: str) -> DataFrame:
    matches = select_documents(t.catalog_of_docs(spark, sf), combine([of_class(["en"])]))
    page = q.search_page(
        matches.select("id", "name", "file_size"), page=2, page_size=20, order_by="file_size",
        order_dir="desc",
    )
    return page


@query(
    "q1_search_deep_page",
    """SELECT o_orderkey AS id, o_totalprice AS price, true AS has_more FROM orders
       ORDER BY o_totalprice NULLS LAST, o_orderkey LIMIT 60 OFFSET 1140""",
)
def deep_page(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")
    )
    return q.search_page(orders, page=20, page_size=60, order_by="price")


@query(
    "q1_search_after",
    """SELECT o_orderkey AS id, o_totalprice AS price FROM orders
       WHERE o_totalprice > 100000.0 OR (o_totalprice = 100000.0 AND o_orderkey > 5)
       ORDER BY 2, 1 LIMIT 50""",
)
def keyset(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")
    )
    return q.search_after(orders, (100000.0, 5), order_by="price")


@query("q2_iterate", sql("SELECT id, name, page_count FROM parts WHERE document_class = 'PROMO'"))
def iterate(spark: SparkSession, sf: str) -> DataFrame:
    matches = select_documents(t.catalog_of_parts(spark, sf), combine([of_class(["PROMO"])]))
    return q.iterate(matches, order_by="page_count", order_dir="desc").select(
        "id", "name", "page_count"
    )


@query(
    "q4_lookup_found",
    "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey IN (SELECT c_custkey * 3 FROM customer)",
)
def lookup_found(spark: SparkSession, sf: str) -> DataFrame:
    return q.lookup(t.projects(spark, sf), _wanted(spark, sf))[0]


@query(
    "q4_lookup_missing",
    "SELECT c_custkey * 3 AS id FROM customer WHERE c_custkey * 3 NOT IN (SELECT s_suppkey FROM supplier)",
)
def lookup_missing(spark: SparkSession, sf: str) -> DataFrame:
    return q.lookup(t.projects(spark, sf), _wanted(spark, sf))[1]


def _wanted(spark: SparkSession, sf: str) -> DataFrame:
    return t.load(spark, sf, "customer").select((F.col("c_custkey") * 3).alias("id"))


@query(
    "q5_job_search",
    sql("""SELECT id, status, strftime(created_at, '%Y-%m-%d') AS created, (SELECT count(*) FROM jobs WHERE
             status IN ('running', 'partial_success') AND created_at >= TIMESTAMP '1996-01-01'
             AND created_at <= TIMESTAMP '1997-12-31') > 50 AS has_more
        FROM jobs WHERE status IN ('running', 'partial_success')
        AND created_at >= TIMESTAMP '1996-01-01' AND created_at <= TIMESTAMP '1997-12-31'
        ORDER BY id DESC LIMIT 50"""),
)
def job_search(spark: SparkSession, sf: str) -> DataFrame:
    found = q.search_jobs(
        t.jobs(spark, sf), statuses=["running", "partial_success"],
        created_from="1996-01-01T00:00:00Z", created_to="1997-12-31T00:00:00Z",
    )
    page = q.search_page(found, order_dir="desc")
    return page.select(
        "id", "status", F.date_format("created_at", "yyyy-MM-dd").alias("created"), "has_more"
    )


@query("q6_folder_search_root", sql("SELECT id, name FROM folders WHERE parent_id IS NULL"))
def folder_roots(spark: SparkSession, sf: str) -> DataFrame:
    return q.search_folders(t.folders(spark, sf)).select("id", "name")


@query("q6_folder_search_children", sql("SELECT id, name FROM folders WHERE parent_id = 103"))
def folder_children(spark: SparkSession, sf: str) -> DataFrame:
    return q.search_folders(t.folders(spark, sf), parent_id=103).select("id", "name")


@query("q7_project_search", sql("SELECT id, name FROM projects WHERE contains(lower(name), '00000001')"))
def project_search(spark: SparkSession, sf: str) -> DataFrame:
    return q.search_projects(t.projects(spark, sf), "00000001")


@query(
    "q7_project_search_edit_distance",
    sql("""SELECT id, name FROM projects
        WHERE levenshtein(lower(name), 'suplier#000000017') <= 2"""),
)
def project_search_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    return q.search_projects(t.projects(spark, sf), "suplier#000000017", max_distance=2)


@query(
    "q7_project_search_by_index",
    sql("""SELECT id, name FROM projects
        WHERE contains(lower(name), 'suplier#000000017') OR levenshtein(lower(name), 'suplier#000000017') <= 2"""),
)
def project_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    projects = t.projects(spark, sf)
    index = materialize(q.name_index(projects).sortWithinPartitions("gram"), "name-index")
    return q.search_projects(projects, "suplier#000000017", max_distance=2, index=index).select("id", "name")


@query(
    "q8_prompt_search_by_index",
    """SELECT p_partkey AS id, p_name AS name FROM part
       WHERE (contains(lower(p_name), 'rde widget') OR levenshtein(lower(p_name), 'rde widget') <= 3) AND p_size <> 7""",
)
def prompt_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    prompts = t.load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), (F.col("p_size") == 7).alias("deleted"),
    )
    index = materialize(q.name_index(prompts).sortWithinPartitions("gram"), "name-index")
    return q.search_prompts(prompts, "Rde widget", max_distance=3, index=index).select("id", "name")


@query(
    "q8_prompt_search",
    """SELECT p_partkey AS id, p_name AS name FROM part
       WHERE contains(lower(p_name), 'red') AND p_type = 'PROMO' AND p_size <> 7""",
)
def prompt_search(spark: SparkSession, sf: str) -> DataFrame:
    prompts = t.load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("document_class"), (F.col("p_size") == 7).alias("deleted"),
    )
    found = q.search_prompts(prompts, "Red", document_class="PROMO")
    return q.iterate(found, order_by="name").select("id", "name")
