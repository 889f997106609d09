"""Sources and sinks (S)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.enums import DOCUMENT_STATUSES, is_ready, normalize_enum
from docloom.operators import downloads
from docloom.operators.extraction import flatten_values
from docloom.schemas import EXTRACTION_RESULTS
from docloom.session import scratch_path
from docloom.sources import export, files, pages
from queryset import tables as t
from queryset.extraction import results
from queryset.registry import query
from queryset.tables import sql

_PAGE = 50


def _text_tree(spark: SparkSession, sf: str) -> str:
    """The documents written as text files, one directory per source."""
    path = scratch_path(spark, "tree")
    t.load(spark, sf, "documents").select("text", "source").write.partitionBy("source").text(path)
    return path


@query(
    "s1_file_manifest",
    """SELECT 'source=' || source AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes
       FROM documents GROUP BY 1""",
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    found = files.file_manifest(spark, _text_tree(spark, sf), pattern="*/*.txt", with_md5=False)
    return found.groupBy(F.substring_index("rel_path", "/", 1).alias("folder")).agg(
        F.sum("size").alias("bytes")
    )


@query(
    "s2_file_md5",
    """SELECT 'source=' || source AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS size,
              md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS md5
       FROM documents GROUP BY 1""",
)
def file_md5(spark: SparkSession, sf: str) -> DataFrame:
    """One file per source, listed and hashed in tasks."""
    path = scratch_path(spark, "tree")
    docs = t.load(spark, sf, "documents").select("text", "source", "doc_id")
    ordered = docs.repartition("source").sortWithinPartitions("source", "doc_id").drop("doc_id")
    ordered.write.partitionBy("source").text(path)
    found = files.file_manifest(spark, path, pattern="*/*.txt")
    return found.select(F.substring_index("rel_path", "/", 1).alias("folder"), "size", "md5")


@query("s2_content_md5", "SELECT doc_id AS id, md5(text) AS md5 FROM documents")
def content_md5(spark: SparkSession, sf: str) -> DataFrame:
    return t.docs(spark, sf).select("id", "md5")


def _page_dump(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as JSON pages of 50 items, written and read back."""
    documents = t.load(spark, sf, "documents")
    even = F.col("doc_id") % 2 == 0
    stamp = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'")
    box = F.struct(F.lit(0.25).alias("Top"), (F.col("n_chars") / 7).alias("Left"))
    traceback = F.array(
        F.struct(box.alias("bbox"), F.lit(2).alias("page"), F.lit(0.5).alias("confidence"))
    )
    value = F.struct(
        F.col("lang").alias("name"), F.lit("Number").alias("data_type"),
        F.col("n_chars").cast("string").alias("value_number"), traceback.alias("traceback"),
    )
    item = F.struct(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc"), "doc_id").alias("name"),
        F.when(even, stamp).alias("createdAt"),
        F.when(~even, stamp).alias("created_at"),
        F.col("n_chars").alias("chars_on_server"),
        F.col("lang").alias("lang"),
        F.array(F.struct(F.lit(9).alias("prompt_id"), value.alias("value"))).alias("extraction_results"),
    )
    last = documents.agg(F.max("doc_id")).scalar()
    page = (F.floor(F.col("doc_id") / _PAGE) + 1).alias("page")
    dump = documents.groupBy(page).agg(F.collect_list(item).alias("items")).withColumns(
        {"page_size": F.lit(_PAGE), "has_more": F.col("page") < F.floor(last / _PAGE) + 1}
    )
    path = scratch_path(spark, "pages")
    dump.write.json(path)
    return pages.read_pages(spark, path)


_DECLARED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


@query("s3_page_items", "SELECT doc_id AS id, 'doc' || doc_id AS name FROM documents")
def page_items(spark: SparkSession, sf: str) -> DataFrame:
    items = pages.page_items(_page_dump(spark, sf))
    return pages.typed_items(items, _DECLARED).select("id", "name")


@query(
    "s3_page_completeness",
    f"""SELECT max(doc_id) // {_PAGE} + 1 AS pages, max(doc_id) // {_PAGE} + 1 AS last_page,
               CAST(1 AS BIGINT) AS ends, true AS is_complete FROM documents""",
)
def page_completeness(spark: SparkSession, sf: str) -> DataFrame:
    facts = pages.page_completeness(_page_dump(spark, sf))
    return facts.select("pages", "last_page", "ends", "is_complete")


@query(
    "s4_open_tail_fields",
    "SELECT doc_id AS id, lang, n_chars AS chars_on_server FROM documents",
)
def open_tail(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.typed_items(pages.page_items(_page_dump(spark, sf)), _DECLARED)
    extra = F.col("_extra")
    return rows.select(
        "id",
        F.variant_get(extra["lang"], "$", "string").alias("lang"),
        F.variant_get(extra["chars_on_server"], "$", "bigint").alias("chars_on_server"),
    )


@query(
    "s5_wire_aliases",
    """SELECT doc_id AS id, strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y-%m-%d %H:%M:%S')
              AS created_at FROM documents""",
)
def wire_aliases(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.typed_items(pages.page_items(_page_dump(spark, sf)), _DECLARED)
    return rows.select("id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@query(
    "s5_wire_aliases_nested",
    """SELECT doc_id AS document_id, CAST(9 AS BIGINT) AS prompt_id, lang AS name, n_chars AS value,
              CAST(0.25 AS DOUBLE) AS top, n_chars / 7.0::DOUBLE AS "left" FROM documents""",
)
def wire_aliases_nested(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.extraction_items(pages.page_items(_page_dump(spark, sf)), EXTRACTION_RESULTS)
    box = F.col("traceback")[0]["bbox"]
    return rows.select(
        "document_id", "prompt_id", "name", F.col("value_number").cast("long").alias("value"),
        box["top"].alias("top"), box["left"].alias("left"),
    )


@query(
    "s6_open_enum",
    sql("""SELECT status, status IN ('uploading', 'processing', 'ready') AS is_known,
               status = 'ready' AS is_ready, count(*) AS events FROM status_events GROUP BY 1"""),
)
def open_enum(spark: SparkSession, sf: str) -> DataFrame:
    flagged = normalize_enum(t.status_events(spark, sf), "status", DOCUMENT_STATUSES)
    return flagged.groupBy(
        "status", F.col("status_is_known").alias("is_known"), is_ready(F.col("status")).alias("is_ready")
    ).agg(F.count("*").alias("events"))


@query(
    "s7_wide_csv_export",
    sql("""SELECT CAST(document_id AS VARCHAR) AS document_id,
            coalesce(max(CASE WHEN name = 'email' THEN raw_value END), '') AS email,
            coalesce(max(CASE WHEN name = 'ipv4' THEN raw_value END), '') AS ipv4,
            coalesce(max(CASE WHEN name = 'token' THEN raw_value END), '') AS token
        FROM results WHERE prompt_id IN (1, 2, 5) GROUP BY document_id"""),
)
def wide_csv(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_values(results(spark, sf).where(F.col("prompt_id").isin(1, 2, 5)))
    path = scratch_path(spark, "csv")
    # Named fields, so that the columns do not depend on which prompts had hits.
    fields = [("name", "email"), ("name", "ipv4"), ("name", "token")]
    export.write_wide_csv(flat, path, fields)
    back = spark.read.option("header", True).option("emptyValue", "").csv(path)
    return back.na.fill("")


_TARGETS = """targets AS (SELECT id, list_filter(string_split(path, '/'), lambda x: x <> '' AND x <> '.')[-1] AS target_name
      FROM url_paths)"""


def _with_targets(body: str) -> str:
    base = sql("SELECT 1 FROM url_paths")
    return base[: base.rindex(" SELECT 1")] + ", " + _TARGETS + " " + body


@query(
    "s8_download_plan",
    _with_targets("""SELECT id, target_name,
         CASE WHEN target_name IN (SELECT target_name FROM targets WHERE id % 7 = 0) THEN 'exists'
              WHEN id > min(id) OVER (PARTITION BY target_name) THEN 'collision' ELSE 'write' END AS outcome
        FROM targets"""),
)
def download_plan(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.url_paths(spark, sf).withColumnRenamed("path", "name")
    there = downloads.plan_downloads(documents.where("id % 7 = 0")).select("target_name")
    return downloads.plan_downloads(documents, there)


@query(
    "s8_download_plan_overwrite",
    _with_targets("""SELECT id, target_name,
         CASE WHEN id > min(id) OVER (PARTITION BY target_name) THEN 'collision' ELSE 'write' END AS outcome
        FROM targets"""),
)
def download_plan_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.url_paths(spark, sf).withColumnRenamed("path", "name")
    there = downloads.plan_downloads(documents.where("id % 7 = 0")).select("target_name")
    return downloads.plan_downloads(documents, there, overwrite=True)


@query(
    "s9_download_all",
    sql("""SELECT id, name AS target_name FROM docs WHERE folder_id IN (104, 105, 106) AND id % 3 <> 0"""),
)
def download_all(spark: SparkSession, sf: str) -> DataFrame:
    catalog = t.catalog_of_docs(spark, sf)
    there = catalog.documents.where("id % 3 = 0").select("name")
    chosen = catalog.documents.where(F.col("folder_id").isin(104, 105, 106))
    return downloads.missing_downloads(chosen.select("id", "name"), there)
