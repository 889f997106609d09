"""Ingest (I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import ingest as i
from docloom.operators.folders import folder_paths
from docloom.operators.projects import get_or_create_projects
from docloom.plans.ingest import IngestResult, ingest_files, load_files
from docloom.session import scratch_path
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql

_MAX_SIZE = 20_000


def _run(spark: SparkSession, sf: str, policy: str = "allow") -> IngestResult:
    return ingest_files(
        t.incoming(spark, sf), t.held(spark, sf), base_key="bulk", on_duplicate=policy,
        max_size=_MAX_SIZE,
    )


def _basenames(spark: SparkSession, sf: str) -> DataFrame:
    return i.with_remote_name(t.url_paths(spark, sf), flatten=True)


@query(
    "i1_remote_names",
    sql("""SELECT id, path AS kept_name, string_split(path, '/')[-1] AS flat_name FROM url_paths"""),
)
def remote_names(spark: SparkSession, sf: str) -> DataFrame:
    kept = i.with_remote_name(t.url_paths(spark, sf), flatten=False)
    flat = i.with_remote_name(kept.withColumnRenamed("file_name", "kept_name"), flatten=True)
    return flat.select("id", "kept_name", F.col("file_name").alias("flat_name"))


@query(
    "i2_repeated_names",
    sql("""SELECT string_split(path, '/')[-1] AS file_name, count(*) AS files FROM url_paths
        GROUP BY 1 HAVING count(*) > 1"""),
)
def repeated_names(spark: SparkSession, sf: str) -> DataFrame:
    return i.repeated_names(_basenames(spark, sf))


@query(
    "i3_content_types",
    sql("""SELECT CASE WHEN suffix(lower(path), '.html') OR suffix(lower(path), '.htm') THEN 'text/html'
               ELSE 'application/octet-stream' END AS content_type, count(*) AS files
        FROM url_paths GROUP BY 1"""),
)
def content_types(spark: SparkSession, sf: str) -> DataFrame:
    typed = i.with_content_type(_basenames(spark, sf))
    return typed.groupBy("content_type").agg(F.count("*").alias("files"))


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    named = i.with_remote_name(t.incoming(spark, sf).drop("text"), flatten=True)
    return i.plan_batches(named, "bulk", order_by=[F.split("path", "/", -1)])


@query(
    "i4_batches",
    sql("""SELECT path, ordinal, ordinal // 100 AS batch_no, printf('bulk-%04d', ordinal // 100) AS batch_key
        FROM planned"""),
)
def batches(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf).select("path", "ordinal", "batch_no", "batch_key")


@query(
    "i5_resume_pending",
    sql("SELECT path, ordinal // 100 AS batch_no FROM planned WHERE (ordinal // 100) % 2 = 1"),
)
def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    planned = _planned(spark, sf)
    ledger = i.batch_payloads(planned).where("batch_no % 2 = 0").select("batch_key", "payload_hash")
    return i.resume_from_ledger(planned, ledger).pending.select("path", "batch_no")


@query(
    "i5_ledger_conflicts",
    sql("""SELECT printf('bulk-%04d', batch_no) AS batch_key, batch_no,
               md5(string_agg(file_name || ':' || md5, chr(10) ORDER BY ordinal)) AS payload_hash
        FROM (SELECT *, ordinal // 100 AS batch_no FROM planned) GROUP BY 2 HAVING batch_no % 3 = 0"""),
)
def ledger_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    planned = _planned(spark, sf)
    changed = F.when(F.col("batch_no") % 3 == 0, "other").otherwise(F.col("payload_hash"))
    ledger = i.batch_payloads(planned).select("batch_key", changed.alias("payload_hash"))
    found = i.resume_from_ledger(planned, ledger).conflicts
    return found.select("batch_key", "batch_no", "payload_hash")


_FAILED = "(SELECT min(batch_no) FROM outcomes WHERE batch_no >= 2 AND error_code = 'FILE_TOO_LARGE')"


@query(
    "i6_partial_progress",
    sql(f"""SELECT path, document_id FROM outcomes
        WHERE batch_no < coalesce({_FAILED}, (SELECT max(batch_no) + 1 FROM outcomes))"""),
)
def partial_progress(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = _run(spark, sf).outcomes
    too_large = F.col("error.code") == "FILE_TOO_LARGE"
    failed = outcomes.where(too_large & (F.col("batch_no") >= 2)).select("batch_no")
    return i.stop_at_first_failure(outcomes, failed).outcomes.select("path", "document_id")


@query(
    "i6_batches_completed",
    sql(f"""SELECT coalesce({_FAILED}, (SELECT max(batch_no) + 1 FROM outcomes)) AS batches_completed,
               {_FAILED} IS NOT NULL AS stopped_early"""),
)
def batches_completed(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = _run(spark, sf).outcomes
    too_large = F.col("error.code") == "FILE_TOO_LARGE"
    failed = outcomes.where(too_large & (F.col("batch_no") >= 2)).select("batch_no")
    return i.stop_at_first_failure(outcomes, failed).progress


@query(
    "i7_duplicate_counts",
    sql("SELECT path, duplicate_count, first_id AS first_duplicate_id FROM outcomes"),
)
def duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    matched = i.match_duplicates(t.incoming(spark, sf), t.held(spark, sf))
    return matched.files.select("path", "duplicate_count", "first_duplicate_id")


@query(
    "i7_duplicate_members",
    sql("SELECT md5, id AS document_id, name FROM held WHERE md5 IN (SELECT md5 FROM incoming)"),
)
def duplicate_members(spark: SparkSession, sf: str) -> DataFrame:
    matched = i.match_duplicates(t.incoming(spark, sf), t.held(spark, sf))
    return matched.members.select("md5", "document_id", "name")


@query(
    "i8_policy_block",
    sql("""SELECT path, document_id, slot AND duplicate_count = 0 AS uploaded,
               slot AND duplicate_count > 0 AS skipped_as_duplicate FROM outcomes"""),
)
def policy_block(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, "block").outcomes.select(
        "path", "document_id", "uploaded", "skipped_as_duplicate"
    )


@query(
    "i8_policy_notify_warnings",
    sql("""SELECT file_name, document_id, duplicate_count, first_id AS first_duplicate_id
        FROM outcomes WHERE slot AND duplicate_count > 0"""),
)
def policy_notify(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, "notify").warnings.drop("md5")


@query(
    "i9_rejections",
    sql("""SELECT file_name, document_id, error_code AS code,
               CASE WHEN size > 20000 THEN size END AS file_size
        FROM outcomes WHERE error_code IS NOT NULL"""),
)
def rejections(spark: SparkSession, sf: str) -> DataFrame:
    bad = _run(spark, sf).outcomes.where(F.col("error").isNotNull())
    return bad.select(
        "file_name", "document_id", F.col("error.code").alias("code"),
        F.col("error.file_size").alias("file_size"),
    )


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the documents in folders by language; ten sources of a language share the names."""
    docs = t.docs(spark, sf)
    name = F.concat_ws("/", F.col("document_class"), F.col("id") % 7, F.concat(F.lit("f"), F.floor(F.col("id") / 10), F.lit(".txt")))
    folder = F.lit(None).cast("long").alias("folder_id")
    return docs.select(name.alias("path"), F.col("file_size").alias("size"), "md5", folder, F.col("id").alias("page_count"))


_NESTED = """WITH nested AS (
  SELECT lang, doc_id % 7 AS part, doc_id // 10 AS number, doc_id, md5(text) AS md5 FROM documents)"""


@query(
    "i1_layout_folders",
    f"""{_NESTED}
        SELECT lang || '/' || part AS folder, count(DISTINCT number) AS documents, count(*) AS files
        FROM nested GROUP BY 1""",
)
def layout_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the folder they landed in, after get-or-create of all folders."""
    run = _nested_run(spark, sf)
    paths = folder_paths(run.folders).select(F.col("id").alias("folder_id"), F.array_join("path_names", "/").alias("folder"))
    placed = run.outcomes.join(paths, "folder_id")
    return placed.groupBy("folder").agg(F.count_if("uploaded").alias("documents"), F.count("*").alias("files"))


@query(
    "i9_places_in_the_set",
    f"""{_NESTED}
        SELECT lang || '/' || part AS folder, 'f' || number || '.txt' AS file_name, count(*) AS files,
               CAST(1 AS BIGINT) AS uploaded, count(*) - 1 AS rejected, CAST(1 AS BIGINT) AS ids
        FROM nested GROUP BY 1, 2""",
)
def places_in_the_set(spark: SparkSession, sf: str) -> DataFrame:
    run = _nested_run(spark, sf)
    paths = folder_paths(run.folders).select(F.col("id").alias("folder_id"), F.array_join("path_names", "/").alias("folder"))
    taken = F.col("error.code") == "NAME_ALREADY_EXISTS"
    return run.outcomes.join(paths, "folder_id").groupBy("folder", "file_name").agg(
        F.count("*").alias("files"), F.count_if("uploaded").alias("uploaded"), F.count_if(taken).alias("rejected"),
        F.count_distinct("document_id").alias("ids"),
    )


def _nested_run(spark: SparkSession, sf: str) -> IngestResult:
    none = spark.createDataFrame([], "id long, name string, folder_id long, md5 string")
    folders = spark.createDataFrame([], "id long, name string, parent_id long")
    return ingest_files(_nested(spark, sf), none, base_key="nested", flatten=False, folders=folders)


@query(
    "i6_failed_and_resumed_run",
    sql("""SELECT path, CASE WHEN ordinal // 100 < 2 THEN 0 ELSE 1 END AS run, ordinal // 100 AS batch_no
        FROM planned p WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.name = p.file_name)"""),
)
def failed_and_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The third batch fails, a second call loads it and all after it: the run that loaded each file."""
    out = scratch_path(spark, "loaded")

    def fails(batch):  # noqa: ANN001, ANN202
        if int(batch["batch_no"].iloc[0]) == 2:
            raise OSError("no route")

    files, held = t.incoming(spark, sf), t.held(spark, sf)
    load_files(files, held, out, base_key="bulk", transfer=fails)
    load_files(files, held, out, base_key="bulk", transfer=lambda batch: None)
    outcomes = spark.read.parquet(f"{out}/outcomes").where("uploaded")
    return outcomes.select("path", F.col("run").cast("int").alias("run"), "batch_no")


_COUNTS = """count(*) AS files, count(*) FILTER (WHERE slot AND duplicate_count = 0) AS succeeded,
    count(*) FILTER (WHERE NOT slot) AS failed, count(*) FILTER (WHERE slot AND duplicate_count > 0) AS skipped,
    count(document_id) AS document_ids"""


@query("i10_outcome_summary", sql(f"SELECT {_COUNTS} FROM outcomes"))
def outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    return i.outcome_summary(_run(spark, sf, "block").outcomes)


@query(
    "i11_project_pin",
    sql("""SELECT (SELECT min(s_suppkey) FROM supplier WHERE s_name = 'Supplier#000000007') AS project_id,
               document_id FROM outcomes WHERE slot"""),
)
def project_pin(spark: SparkSession, sf: str) -> DataFrame:
    projects = t.projects(spark, sf)
    wanted = projects.where(F.col("name") == "Supplier#000000007").select("name")
    project_id = get_or_create_projects(projects, wanted).resolved.first()["id"]
    return i.pin_project(_run(spark, sf).outcomes, project_id).select("project_id", "document_id")


@query(
    "i12_tag_pin",
    """SELECT tag_id, arg_max(name, batch_no) AS name FROM (
         SELECT p_partkey // 100 AS batch_no, CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS tag_id,
                max(p_type) AS name FROM part GROUP BY 1, 2) GROUP BY 1""",
)
def tag_pin(spark: SparkSession, sf: str) -> DataFrame:
    reported = t.load(spark, sf, "part").groupBy(
        F.floor(F.col("p_partkey") / 100).alias("batch_no"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("long").alias("tag_id"),
    ).agg(F.max("p_type").alias("name"))
    return i.pin_tags(reported)


@query(
    "i12_tagged_documents",
    sql("""SELECT document_id, CAST(tag_id AS BIGINT) AS tag_id FROM outcomes, (VALUES (4), (9)) v(tag_id)
        WHERE slot"""),
)
def tagged_documents(spark: SparkSession, sf: str) -> DataFrame:
    return i.tag_documents(_run(spark, sf).outcomes, [4, 9]).select("document_id", "tag_id")


@query(
    "i13_batch_summaries",
    sql(f"SELECT batch_no, printf('bulk-%04d', batch_no) AS batch_key, {_COUNTS} FROM outcomes GROUP BY 1"),
)
def batch_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf, "block").batches
