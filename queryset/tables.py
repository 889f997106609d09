"""The document model read out of the given tables, in Spark and as SQL views.

Each Spark builder has a CTE of the same name in ``VIEWS``; ``sql(body)`` puts
the CTEs that ``body`` mentions in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.extraction import ExtractRule
from docloom.operators.selectors import Catalog

# Patterns that Java and RE2 read alike (fixed values).
RULES = [
    ExtractRule(1, "email", "String", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+"),
    ExtractRule(2, "ipv4", "String", r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"),
    ExtractRule(3, "phone", "String", r"[+]1 [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}"),
    ExtractRule(4, "card16", "Number", r"[0-9]{16}"),
    ExtractRule(5, "token", "String", r"[0-9a-f]{32,}"),
]

#: Scale under which a 16-digit number fits the decimal type.
WIDE_SCALE = 6

REGION_BASE, NATION_BASE, CUSTOMER_BASE = 1, 101, 1001

_EVENT_STATUS = {"signup": "uploading", "view": "processing", "purchase": "ready"}
_ORDER_STATUS = {"F": "completed", "O": "running", "P": "partial_success"}


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _mapped(column: str, mapping: dict[str, str], default) -> "F.Column":  # noqa: ANN001
    picked = None
    for raw, value in mapping.items():
        here = F.col(column) == raw
        picked = F.when(here, value) if picked is None else picked.when(here, value)
    return picked.otherwise(default)


def _case(column: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{raw}' THEN '{value}'" for raw, value in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


def spread(spark: SparkSession) -> int | None:
    """Tasks to deal texts to before patterns run over them, if the session asks for it (``docloom.spread``)."""
    found = spark.conf.get("docloom.spread", None)
    return int(found) if found else None


def docs(spark: SparkSession, sf: str, *, labels: bool = False) -> DataFrame:
    """Text documents in nation folders; ``labels`` adds is_valid and has_active_workflow."""
    table = load(spark, sf, "documents")
    if labels:
        table = table.join(load(spark, sf, "labels"), "doc_id", "left")
    columns = [
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc"), F.col("doc_id"), F.lit(".txt")).alias("name"),
        (F.expr("substring(source, 4)").cast("long") + NATION_BASE).alias("folder_id"),
        F.col("lang").alias("document_class"),
        F.octet_length("text").cast("long").alias("file_size"),
        F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 3000)).alias("page_count"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("created_at"),
        F.md5("text").alias("md5"),
        "text",
        "source",
    ]
    if labels:
        columns += [
            F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_valid"),
            F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("has_active_workflow"),
        ]
    return table.select(*columns)


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """A second catalog: one document per part."""
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("document_class"),
        F.col("p_size").cast("long").alias("page_count"),
    )


def document_tags(spark: SparkSession, sf: str) -> DataFrame:
    shipped = (
        load(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.min("l_shipdate").cast("timestamp").alias("tagged_at"))
    )
    return load(spark, sf, "part").join(shipped, "p_partkey").select(
        F.col("p_partkey").alias("document_id"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("long").alias("tag_id"),
        "tagged_at",
    )


def project_documents(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("project_id"), F.col("l_partkey").alias("document_id")
    ).agg(F.min("l_shipdate").cast("timestamp").alias("created_at"))


def job_documents(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.bool_or(F.col("l_returnflag") == "R")
    open_ = F.bool_or(F.col("l_linestatus") == "O")
    return load(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("document_id")
    ).agg(F.when(bad, "failed").when(open_, "running").otherwise("completed").alias("status"))


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        _mapped("o_orderstatus", _ORDER_STATUS, F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def projects(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )


def folders(spark: SparkSession, sf: str) -> DataFrame:
    """region -> nation -> customer."""
    region = load(spark, sf, "region").select(
        (F.col("r_regionkey") + REGION_BASE).cast("long").alias("id"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("long").alias("parent_id"),
    )
    nation = load(spark, sf, "nation").select(
        (F.col("n_nationkey") + NATION_BASE).cast("long").alias("id"),
        F.col("n_name").alias("name"),
        (F.col("n_regionkey") + REGION_BASE).cast("long").alias("parent_id"),
    )
    customer = load(spark, sf, "customer").select(
        (F.col("c_custkey") + CUSTOMER_BASE).cast("long").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + NATION_BASE).cast("long").alias("parent_id"),
    )
    return region.unionByName(nation).unionByName(customer)


def splits(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as source documents, their turns as child splits."""
    turns = load(spark, sf, "conversations")
    source = turns.select("conv_id").distinct().select(
        F.col("conv_id").alias("id"), F.lit(None).cast("long").alias("source_document")
    )
    child = turns.select(
        (F.lit(1_000_000) + F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("source_document"),
    )
    return source.unionByName(child)


def status_events(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("user_id").alias("subject_id"),
        _mapped("event_type", _EVENT_STATUS, F.col("event_type")).alias("status"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.concat_ws("-", "user_id", "event_type").alias("key"),
        F.md5("props").alias("payload_hash"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("request_id"),
    )


def url_paths(spark: SparkSession, sf: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", "")
    return load(spark, sf, "pages").select(F.col("page_id").alias("id"), bare.alias("path"))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Files to load: odd documents, a fifth of them under a name that is taken."""
    odd = docs(spark, sf).where(F.col("id") % 2 == 1)
    named = F.when(F.col("id") % 10 == 1, F.col("id") - 1).otherwise(F.col("id"))
    return odd.select(
        F.concat(F.lit("in/doc"), named, F.lit(".txt")).alias("path"),
        F.col("file_size").alias("size"),
        "md5",
        F.lit(None).cast("long").alias("folder_id"),
        "text",
    )


def held(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog that incoming files meet: even documents, all at the root."""
    even = docs(spark, sf).where(F.col("id") % 2 == 0)
    return even.select(
        "id", "name", F.lit(None).cast("long").alias("folder_id"), "md5", "text", "page_count"
    )


def catalog_of_docs(spark: SparkSession, sf: str, *, labels: bool = False) -> Catalog:
    return Catalog(docs(spark, sf, labels=labels), folders=folders(spark, sf))


def catalog_of_parts(spark: SparkSession, sf: str) -> Catalog:
    return Catalog(
        parts(spark, sf),
        document_tags=document_tags(spark, sf),
        project_documents=project_documents(spark, sf),
        job_documents=job_documents(spark, sf),
    )


def _regex_rows() -> str:
    rows = []
    for position, rule in enumerate(RULES):
        hit = f"nullif(regexp_extract(text, '{rule.pattern}'), '')"
        rows.append(
            f"SELECT doc_id AS document_id, {position} AS position, "
            f"CAST({rule.prompt_id} AS BIGINT) AS prompt_id, '{rule.name}' AS name, "
            f"'{rule.data_type}' AS data_type, {hit} AS raw_value FROM documents"
        )
    return "SELECT * FROM (" + " UNION ALL ".join(rows) + ") WHERE raw_value IS NOT NULL"


VIEWS = {
    "docs": f"""
        SELECT d.doc_id AS id, 'doc' || d.doc_id || '.txt' AS name,
               CAST(substr(d.source, 4) AS BIGINT) + {NATION_BASE} AS folder_id,
               d.lang AS document_class, CAST(strlen(d.text) AS BIGINT) AS file_size,
               greatest(1, CAST(ceil(d.n_chars / 3000.0) AS BIGINT)) AS page_count,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id) AS created_at,
               md5(d.text) AS md5, d.text, d.source,
               coalesce(l.quality = 1, false) AS is_valid,
               coalesce(l.toxic = 1, false) AS has_active_workflow
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "parts": """
        SELECT p_partkey AS id, p_name AS name, p_type AS document_class,
               CAST(p_size AS BIGINT) AS page_count FROM part""",
    "document_tags": """
        SELECT p_partkey AS document_id,
               CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS tag_id, tagged_at
        FROM part JOIN (SELECT l_partkey, min(l_shipdate) AS tagged_at FROM lineitem GROUP BY 1)
             ON p_partkey = l_partkey""",
    "project_documents": """
        SELECT l_suppkey AS project_id, l_partkey AS document_id, min(l_shipdate) AS created_at
        FROM lineitem GROUP BY 1, 2""",
    "job_documents": """
        SELECT l_orderkey AS job_id, l_partkey AS document_id,
               CASE WHEN bool_or(l_returnflag = 'R') THEN 'failed'
                    WHEN bool_or(l_linestatus = 'O') THEN 'running'
                    ELSE 'completed' END AS status
        FROM lineitem GROUP BY 1, 2""",
    "jobs": f"""
        SELECT o_orderkey AS id, {_case("o_orderstatus", _ORDER_STATUS, "o_orderstatus")} AS status,
               o_orderdate AS created_at FROM orders""",
    "projects": "SELECT s_suppkey AS id, s_name AS name FROM supplier",
    "folders": f"""
        SELECT CAST(r_regionkey + {REGION_BASE} AS BIGINT) AS id, r_name AS name,
               CAST(NULL AS BIGINT) AS parent_id FROM region
        UNION ALL SELECT n_nationkey + {NATION_BASE}, n_name, n_regionkey + {REGION_BASE} FROM nation
        UNION ALL SELECT c_custkey + {CUSTOMER_BASE}, c_name, c_nationkey + {NATION_BASE}
        FROM customer""",
    "closure": """
        SELECT id AS ancestor_id, id AS descendant_id, CAST(0 AS BIGINT) AS depth FROM folders
        UNION ALL
        SELECT p.id, f.id, CAST(1 AS BIGINT) FROM folders f JOIN folders p ON f.parent_id = p.id
        UNION ALL
        SELECT g.id, f.id, CAST(2 AS BIGINT) FROM folders f JOIN folders p ON f.parent_id = p.id
        JOIN folders g ON p.parent_id = g.id""",
    "splits": """
        SELECT DISTINCT conv_id AS id, CAST(NULL AS BIGINT) AS source_document FROM conversations
        UNION ALL SELECT 1000000 + conv_id * 1000 + turn, conv_id FROM conversations""",
    "status_events": f"""
        SELECT user_id AS subject_id, {_case("event_type", _EVENT_STATUS, "event_type")} AS status,
               ts FROM events""",
    "requests": """
        SELECT user_id || '-' || event_type AS key, md5(props) AS payload_hash, ts,
               event_id AS request_id FROM events""",
    "url_paths": """
        SELECT page_id AS id, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')
               AS path FROM pages""",
    "held": """
        SELECT id, name, CAST(NULL AS BIGINT) AS folder_id, md5, text, page_count
        FROM docs WHERE id % 2 = 0""",
    "incoming": """
        SELECT 'in/doc' || (CASE WHEN id % 10 = 1 THEN id - 1 ELSE id END) || '.txt' AS path,
               'doc' || (CASE WHEN id % 10 = 1 THEN id - 1 ELSE id END) || '.txt' AS file_name,
               file_size AS size, md5, text, id FROM docs WHERE id % 2 = 1""",
    "planned": """
        SELECT *, CAST(row_number() OVER (ORDER BY path) - 1 AS BIGINT) AS ordinal FROM incoming""",
    "outcomes": """
        SELECT p.*, h.id AS holder_id, coalesce(m.n, 0) AS duplicate_count, m.first_id,
               p.ordinal // 100 AS batch_no,
               h.id IS NULL AND p.size <= 20000 AS slot,
               CASE WHEN h.id IS NOT NULL THEN 'NAME_ALREADY_EXISTS'
                    WHEN p.size > 20000 THEN 'FILE_TOO_LARGE' END AS error_code,
               CASE WHEN h.id IS NOT NULL THEN h.id
                    WHEN p.size <= 20000 THEN (SELECT max(id) FROM held) + 1 + p.ordinal
               END AS document_id
        FROM planned p LEFT JOIN held h ON h.name = p.file_name
        LEFT JOIN (SELECT md5, count(*) AS n, min(id) AS first_id FROM held GROUP BY 1) m
             ON m.md5 = p.md5""",
    "results": _regex_rows(),
    "li_docs": """
        SELECT l_orderkey * 10 + l_linenumber AS id, max(l_extendedprice) AS price,
               max(l_shipdate) AS shipped, max(l_linestatus) AS linestatus,
               max(l_returnflag) AS flag
        FROM lineitem GROUP BY 1""",
}


def sql(body: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in ordered and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(view)
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    return f"WITH {ctes} {body}"


def sql_number(expression: str) -> str:
    """Shortest rendering of a decimal, as the library's ``number_text`` gives it."""
    text = f"CAST({expression} AS VARCHAR)"
    return f"CASE WHEN contains({text}, '.') THEN rtrim(rtrim({text}, '0'), '.') ELSE {text} END"


#: Documents of a task that sorts their items, five wide rows each.
DOCS_PER_TASK = 100_000


def typed_raw(spark: SparkSession, sf: str, *, docs_per_task: int | None = None) -> DataFrame:
    """Result rows with raw texts of all four data types, out of line items.

    ``docs_per_task`` deals the documents to tasks of about so many at most, for callers that
    sort their items (counts the line items).  Tasks are otherwise sized by the bytes of
    one packed row per document, which is little next to the rows made out of it.
    """
    rows = load(spark, sf, "lineitem").groupBy(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("document_id")
    ).agg(
        F.max("l_extendedprice").alias("price"),
        F.max("l_shipdate").alias("shipped"),
        F.max("l_linestatus").alias("linestatus"),
        F.max("l_returnflag").alias("flag"),
    )
    if docs_per_task:
        most = load(spark, sf, "lineitem").count()
        rows = rows.repartition(max(1, -(-most // docs_per_task)), "document_id")
    money = F.concat(F.lit("$"), F.format_number(F.col("price").cast("decimal(18,2)"), 2))

    def item(position: int, prompt: int, name: str | None, kind: str, raw):  # noqa: ANN001, ANN202
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(prompt).cast("long").alias("prompt_id"),
            F.lit(name).cast("string").alias("name"),
            F.lit(kind).alias("data_type"),
            raw.alias("raw_value"),
        )

    items = [
        item(0, 5, "Total", "Number", money),
        item(1, 6, "Shipped", "Date", F.date_format("shipped", "MM/dd/yyyy")),
        item(2, 7, "Open", "Boolean", F.when(F.col("linestatus") == "O", "Yes").otherwise("No")),
        item(3, 8, None, "String", F.when(F.col("flag") == "N", F.lit("")).otherwise(F.col("flag"))),
        item(4, 9, "Received", "Date", F.lit("Not Found")),
    ]
    return rows.select("document_id", F.explode(F.array(*items)).alias("i")).select(
        "document_id", "i.*"
    )
