"""Extraction results (X)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.values import number_text
from docloom.operators import extraction as ex
from docloom.operators.selectors import Catalog, classified, combine, select_documents, sized_between
from docloom.session import materialize
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql, sql_number

_NUMBER = "TRY_CAST(raw_value AS DECIMAL(38,6))"
_VALUE = f"CASE WHEN data_type = 'Number' THEN {sql_number(_NUMBER)} ELSE raw_value END"


def results(spark: SparkSession, sf: str) -> DataFrame:
    return ex.run_extractor(t.docs(spark, sf), t.RULES, scale=t.WIDE_SCALE, spread=t.spread(spark))


def stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """The results as a stored table, for queries that read it more than once."""
    return materialize(results(spark, sf), "results")


@query(
    "flagship_extract_values",
    sql(
        f"""SELECT r.document_id, r.prompt_id, r.name AS field_key,
               CASE WHEN data_type = 'Number' THEN 'number' ELSE 'text' END AS value_type,
               {_VALUE} AS value
        FROM results r JOIN docs d ON d.id = r.document_id
        WHERE d.file_size BETWEEN 200 AND 2000000 AND d.document_class IS NOT NULL"""
    ),
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    chosen = select_documents(
        Catalog(t.docs(spark, sf)),
        combine(include=[classified(), sized_between(200, 2_000_000)]),
    )
    found = ex.run_extractor(chosen, t.RULES, scale=t.WIDE_SCALE, spread=t.spread(spark))
    return ex.flatten_values(found, rules=t.RULES).select(
        "document_id", "prompt_id", "field_key", "value_type", "value"
    )


@query(
    "x1_typed_value",
    sql(
        f"""SELECT id AS document_id, CAST(5 AS BIGINT) AS prompt_id, 'number' AS value_type,
                {sql_number("CAST(price AS DECIMAL(18,2))")} AS value FROM li_docs
        UNION ALL SELECT id, 6, 'date', strftime(shipped, '%Y-%m-%d') FROM li_docs
        UNION ALL SELECT id, 7, 'bool', CASE WHEN linestatus = 'O' THEN 'true' ELSE 'false' END FROM li_docs
        UNION ALL SELECT id, 8, 'text', CASE WHEN flag = 'N' THEN '' ELSE flag END FROM li_docs
        UNION ALL SELECT id, 9, NULL, NULL FROM li_docs"""
    ),
)
def typed_value(spark: SparkSession, sf: str) -> DataFrame:
    typed = ex.with_value_type(ex.type_raw_values(t.typed_raw(spark, sf)))
    return typed.select("document_id", "prompt_id", "value_type", "value")


@query(
    "x2_type_raw_text",
    sql(
        f"""SELECT data_type, count(*) AS items, count(value_number) AS numbers, count(value_date) AS dates,
               count(value_bool) AS bools, count(value_text) AS texts,
               {sql_number("sum(value_number)")} AS number_sum, min(value_date) AS first_date
        FROM (
          SELECT 'Number' AS data_type, CAST(price AS DECIMAL(18,2)) AS value_number,
                 CAST(NULL AS DATE) AS value_date, CAST(NULL AS BOOLEAN) AS value_bool,
                 CAST(NULL AS VARCHAR) AS value_text FROM li_docs
          UNION ALL SELECT 'Date', NULL, CAST(shipped AS DATE), NULL, NULL FROM li_docs
          UNION ALL SELECT 'Date', NULL, NULL, NULL, NULL FROM li_docs
          UNION ALL SELECT 'Boolean', NULL, NULL, linestatus = 'O', NULL FROM li_docs
          UNION ALL SELECT 'String', NULL, NULL, NULL, flag FROM li_docs)
        GROUP BY 1"""
    ),
)
def type_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    typed = ex.type_raw_values(t.typed_raw(spark, sf))
    return typed.groupBy("data_type").agg(
        F.count("*").alias("items"),
        F.count("value_number").alias("numbers"),
        F.count("value_date").alias("dates"),
        F.count("value_bool").alias("bools"),
        F.count("value_text").alias("texts"),
        number_text(F.sum(F.col("value_number").cast("decimal(28,2)"))).alias("number_sum"),
        F.min("value_date").alias("first_date"),
    )


@query(
    "x2_number_overflow",
    sql(
        """SELECT document_id, raw_value, true AS number_overflow, CAST(NULL AS VARCHAR) AS value
        FROM results WHERE prompt_id = 4"""
    ),
)
def number_overflow(spark: SparkSession, sf: str) -> DataFrame:
    # 16 integer digits do not fit next to 23 fraction digits: flagged, text kept.
    found = ex.run_extractor(t.docs(spark, sf), [t.RULES[3]])
    return ex.with_value_type(found).select("document_id", "raw_value", "number_overflow", "value")


def _with_processing(found: DataFrame) -> DataFrame:
    """Every third document is re-running; its phone answers are not there yet."""
    rerun = F.col("document_id") % 3 == 0
    lost = rerun & (F.col("prompt_id") == 3)
    return found.withColumns(
        {
            "is_processing": F.when(rerun, True),
            "raw_value": F.when(~lost, F.col("raw_value")),
            "value_text": F.when(~lost, F.col("value_text")),
        }
    )


@query(
    "x3_drop_pending",
    sql(
        """SELECT document_id, prompt_id, raw_value FROM results
        WHERE NOT (document_id % 3 = 0 AND prompt_id = 3)"""
    ),
)
def drop_pending(spark: SparkSession, sf: str) -> DataFrame:
    rows = ex.drop_pending(_with_processing(results(spark, sf)))
    return rows.select("document_id", "prompt_id", "raw_value")


@query(
    "x4_field_key",
    sql(
        """SELECT id AS document_id, CAST(prompt_id AS BIGINT) AS prompt_id, key_kind, field_key FROM li_docs,
        (VALUES (5,'name','Total'),(6,'name','Shipped'),(7,'name','Open'),(8,'prompt_id','8'),
                (9,'name','Received')) k(prompt_id, key_kind, field_key)"""
    ),
)
def field_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = ex.with_field_key(t.typed_raw(spark, sf))
    return keyed.select("document_id", "prompt_id", "key_kind", "field_key")


@query(
    "x5_key_collisions",
    sql(
        """SELECT document_id, 'name' AS key_kind, 'contact' AS field_key, count(*) AS items,
               min(prompt_id) AS first_prompt_id, max(prompt_id) AS last_prompt_id
        FROM results WHERE prompt_id IN (1, 3) GROUP BY 1 HAVING count(*) > 1"""
    ),
)
def key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    shared = F.when(F.col("prompt_id").isin(1, 3), "contact").otherwise(F.col("name"))
    return ex.key_collisions(ex.with_field_key(results(spark, sf).withColumn("name", shared)))


@query(
    "x6_flatten_with_empty_documents",
    sql(
        f"""SELECT d.id AS document_id, r.name AS field_key, {_VALUE} AS value
        FROM docs d LEFT JOIN results r ON r.document_id = d.id"""
    ),
)
def flatten(spark: SparkSession, sf: str) -> DataFrame:
    flat = ex.flatten_values(stored_results(spark, sf), documents=t.docs(spark, sf), rules=t.RULES)
    return flat.select("document_id", "field_key", "value")


@query(
    "x7_wide_table",
    sql(
        f"""SELECT document_id, max(CASE WHEN name = 'email' THEN {_VALUE} END) AS email,
               max(CASE WHEN name = 'ipv4' THEN {_VALUE} END) AS ipv4,
               max(CASE WHEN name = 'phone' THEN {_VALUE} END) AS phone,
               max(CASE WHEN name = 'card16' THEN {_VALUE} END) AS card16,
               max(CASE WHEN name = 'token' THEN {_VALUE} END) AS token
        FROM results GROUP BY 1"""
    ),
)
def wide(spark: SparkSession, sf: str) -> DataFrame:
    flat = ex.flatten_values(results(spark, sf), strict=False)  # the pivot checks its cells
    return ex.pivot_values(flat, ["email", "ipv4", "phone", "card16", "token"])


@query(
    "x7_wide_table_typed",
    sql(
        f"""SELECT id AS document_id, {sql_number("CAST(price AS DECIMAL(18,2))")} AS "Total",
               strftime(shipped, '%Y-%m-%d') AS "Shipped",
               CASE WHEN linestatus = 'O' THEN 'true' ELSE 'false' END AS "Open",
               CASE WHEN flag = 'N' THEN '' ELSE flag END AS "8"
        FROM li_docs"""
    ),
)
def wide_typed(spark: SparkSession, sf: str) -> DataFrame:
    raw = t.typed_raw(spark, sf, docs_per_task=t.DOCS_PER_TASK)
    flat = ex.flatten_values(ex.type_raw_values(raw), strict=False)
    return ex.pivot_values(flat, ["Total", "Shipped", "Open", ("prompt_id", "8")])


@query(
    "x8_last_per_prompt",
    """SELECT l_orderkey AS document_id, CAST(l_linenumber AS BIGINT) AS prompt_id,
              max(l_partkey * 1000000 + l_suppkey) AS last_item
       FROM lineitem GROUP BY 1, 2""",
)
def last_per_prompt(spark: SparkSession, sf: str) -> DataFrame:
    items = t.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("document_id"),
        F.col("l_linenumber").cast("long").alias("prompt_id"),
        (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("position"),
    ).withColumn("last_item", F.col("position"))
    return ex.last_per_prompt(items).select("document_id", "prompt_id", "last_item")


@query(
    "x9_pending_placeholders",
    sql(
        """SELECT document_id, prompt_id, raw_value, false AS is_processing
        FROM results WHERE prompt_id IN (1, 2, 3)
          AND document_id IN (SELECT id FROM docs WHERE document_class IN ('en', 'de'))
        UNION ALL
        SELECT d.id, p.prompt_id, NULL, true
        FROM docs d, (VALUES (1), (2), (3)) p(prompt_id)
        WHERE d.has_active_workflow AND d.document_class IN ('en', 'de') AND NOT EXISTS (
          SELECT 1 FROM results r WHERE r.document_id = d.id AND r.prompt_id = p.prompt_id)"""
    ),
)
def pending(spark: SparkSession, sf: str) -> DataFrame:
    # A selection: results of other documents must not come back.
    documents = t.docs(spark, sf, labels=True).where(F.col("document_class").isin("en", "de"))
    found = stored_results(spark, sf)
    rows = ex.with_pending_placeholders(documents, found, [1, 2, 3])
    return rows.select("document_id", "prompt_id", "raw_value", "is_processing")


@query(
    "x10_traceback_audit",
    """SELECT l_orderkey AS document_id, l_partkey AS prompt_id, n AS item_no,
              CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS BIGINT) + n END AS page,
              CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS confidence,
              CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS "left"
       FROM lineitem, (VALUES (0), (1)) v(n)
       WHERE l_linenumber <> 1
       UNION ALL SELECT l_orderkey, l_partkey, NULL, NULL, NULL, NULL FROM lineitem
       WHERE l_linenumber = 1""",
)
def traceback_audit(spark: SparkSession, sf: str) -> DataFrame:
    return ex.traceback_rows(_traced(spark, sf)).select(
        "document_id", "prompt_id", "item_no", "page", "confidence", "left"
    )


@query(
    "x10_traceback_issues",
    """SELECT l_orderkey AS document_id, l_partkey AS prompt_id, n AS item_no, l_returnflag AS issue
       FROM lineitem, (VALUES (0), (1)) v(n) WHERE l_linenumber <> 1 AND l_returnflag <> 'N'""",
)
def traceback_issues(spark: SparkSession, sf: str) -> DataFrame:
    return ex.traceback_issues(_traced(spark, sf)).select(
        "document_id", "prompt_id", "item_no", "issue"
    )


def _traced(spark: SparkSession, sf: str) -> DataFrame:
    def item(n: int):  # noqa: ANN202
        box = F.struct(
            F.col("l_discount").alias("top"), F.col("l_tax").alias("left"),
            F.lit(0.1).alias("width"), F.lit(0.2).alias("height"),
        )
        issues = F.when(F.col("l_returnflag") != "N", F.array("l_returnflag")).otherwise(
            F.array().cast("array<string>")
        )
        return F.struct(
            box.alias("bbox"),
            (F.col("l_linenumber").cast("long") + n).alias("page"),
            F.col("l_discount").alias("confidence"),
            issues.alias("issues"),
        )

    return t.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("document_id"),
        F.col("l_partkey").alias("prompt_id"),
        F.when(F.col("l_linenumber") != 1, F.array(item(0), item(1))).alias("traceback"),
    )


@query("x11_extractor_step", sql("SELECT document_id, position, prompt_id, name, data_type, raw_value FROM results"))
def extractor_step(spark: SparkSession, sf: str) -> DataFrame:
    return results(spark, sf).select(
        "document_id", "position", "prompt_id", "name", "data_type", "raw_value"
    )


@query(
    "x11_user_extractor",
    "SELECT doc_id AS document_id, CAST(11 AS BIGINT) AS prompt_id, CAST(length(text) AS VARCHAR) AS raw_value, CAST(length(text) AS BIGINT) AS value FROM documents WHERE length(text) > 1000",
)
def user_extractor(spark: SparkSession, sf: str) -> DataFrame:
    def long_texts(texts):  # noqa: ANN001, ANN202
        return [str(n) if n > 1000 else None for n in texts.str.len()]

    found = ex.run_user_extractor(t.docs(spark, sf), {11: ("length", "Number", long_texts)})
    return found.select(
        "document_id", "prompt_id", "raw_value", F.col("value_number").cast("long").alias("value")
    )


_CLASS_RULES = [
    ex.ClassRule("contact", t.RULES[0].pattern, 2),
    ex.ClassRule("contact", t.RULES[2].pattern, 1),
    ex.ClassRule("network", t.RULES[1].pattern, 2, "host"),
    ex.ClassRule("secret", t.RULES[4].pattern, 3),
]


#: A hundred prompts: the first word that begins with th and two given letters, and the word after it.
_MANY_RULES = [
    ex.ExtractRule(1000 + n, f"th{a}{b}", "String", rf"th{a}{b}[a-z]* [a-z]+")
    for n, (a, b) in enumerate(product("aeionrstwh", repeat=2))
]


@query(
    "x11_many_prompts",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id AS document_id, CAST({r.prompt_id} AS BIGINT) AS prompt_id, "
        f"nullif(regexp_extract(text, '{r.pattern}'), '') AS raw_value FROM documents"
        for r in _MANY_RULES
    )
    + ") WHERE raw_value IS NOT NULL",
)
def many_prompts(spark: SparkSession, sf: str) -> DataFrame:
    found = ex.run_extractor(t.docs(spark, sf), _MANY_RULES, spread=t.spread(spark))
    return found.select("document_id", "prompt_id", "raw_value")


@query(
    "x12_classifier_step",
    f"""SELECT doc_id AS document_id,
          CASE WHEN greatest(a, b, c) = 0 THEN NULL WHEN a >= b AND a >= c THEN 'contact'
               WHEN b >= c THEN 'network' ELSE 'secret' END AS document_class,
          CASE WHEN b > a AND b >= c THEN 'host' END AS document_subclass
        FROM (SELECT doc_id,
          2 * CAST(regexp_matches(text, '{t.RULES[0].pattern}') AS INT)
            + CAST(regexp_matches(text, '{t.RULES[2].pattern}') AS INT) AS a,
          2 * CAST(regexp_matches(text, '{t.RULES[1].pattern}') AS INT) AS b,
          3 * CAST(regexp_matches(text, '{t.RULES[4].pattern}') AS INT) AS c FROM documents)""",
)
def classifier_step(spark: SparkSession, sf: str) -> DataFrame:
    labelled = ex.run_classifier(t.docs(spark, sf).select("id", "text"), _CLASS_RULES, spread=t.spread(spark))
    return labelled.select(F.col("id").alias("document_id"), "document_class", "document_subclass")


@query(
    "x13_splitter_step",
    """SELECT (SELECT max(doc_id) FROM documents) + 1
                + doc_id * (SELECT max(len(string_split(text, chr(10)))) FROM documents) + pos AS id,
              doc_id AS source_document, pos AS position, md5(piece) AS piece_md5
       FROM (SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS piece
             FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))
       WHERE trim(piece, ' ') <> ''""",
)
def splitter_step(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.docs(spark, sf)
    first_id = documents.agg(F.max("id")).first()[0] + 1
    children = ex.run_splitter(documents, "\n", first_id=first_id)
    return children.select("id", "source_document", "position", F.md5("text").alias("piece_md5"))


@query(
    "q3_projection_by_prompts",
    sql(
        """SELECT d.id, d.name, r.prompt_id, r.raw_value FROM docs d
        LEFT JOIN results r ON r.document_id = d.id AND r.prompt_id IN (1, 2)"""
    ),
)
def projection_by_prompts(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.docs(spark, sf).select("id", "name")
    joined = ex.attach_results(documents, stored_results(spark, sf), [1, 2])
    return joined.select("id", "name", "prompt_id", "raw_value")


@query(
    "q3_nested_results",
    sql(
        """SELECT d.id, string_agg(r.prompt_id || '=' || r.raw_value, ';' ORDER BY r.position) AS items
        FROM docs d LEFT JOIN results r ON r.document_id = d.id AND r.prompt_id IN (1, 3, 5)
        GROUP BY d.id"""
    ),
)
def nested_results(spark: SparkSession, sf: str) -> DataFrame:
    documents = t.docs(spark, sf).select("id", "name")
    nested = ex.nest_results(documents, results(spark, sf), [1, 3, 5])
    parts = F.transform(
        "extraction_results",
        lambda i: F.concat(i["prompt_id"].cast("string"), F.lit("="), i["value"]["raw_value"]),
    )
    return nested.select("id", F.array_join(parts, ";").alias("items"))
