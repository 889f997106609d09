"""Streams (T), each run over the given tables until they are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import scratch_path
from docloom.sources.files import write_text_per_key
from docloom.streaming.ingest import ingest_stream
from docloom.streaming.replay import first_requests_stream
from docloom.streaming.status import (
    complete_readiness,
    completion_stream,
    ready_documents_stream,
    set_readiness_stream,
    unknown_status_stream,
)
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = t.load(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    status = t._mapped("event_type", t._EVENT_STATUS, F.col("event_type"))
    return raw.select(
        F.col("user_id").alias("subject_id"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id", "event_type", "props",
    )


def _drain(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream to its end into a table and return the table."""
    spark = stream.sparkSession
    root = scratch_path(spark, label)
    running = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", root + "/progress")
        .trigger(availableNow=True)
        .start(root + "/table")
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(root + "/table")


@query(
    "t1_completion_stream",
    sql("""SELECT subject_id * 100 + day(ts) AS subject_id,
          CASE WHEN count(*) FILTER (WHERE status = 'ready' AND ts <= date_trunc('day', ts) + INTERVAL 12 HOUR) > 0
               THEN 'done' ELSE 'timeout' END AS outcome,
          CASE WHEN count(*) FILTER (WHERE status = 'ready' AND ts <= date_trunc('day', ts) + INTERVAL 12 HOUR) > 0
               THEN 'ready' END AS status,
          strftime(coalesce(min(ts) FILTER (WHERE status = 'ready' AND ts <= date_trunc('day', ts) + INTERVAL 12 HOUR),
                   min(date_trunc('day', ts)) + INTERVAL 12 HOUR), '%Y-%m-%d %H:%M:%S.%f') AS ended_at
        FROM status_events GROUP BY 1"""),
)
def completions(spark: SparkSession, sf: str) -> DataFrame:
    events = _event_stream(spark, sf).select(
        (F.col("subject_id") * 100 + F.dayofmonth("ts")).alias("subject_id"),
        "status", "ts", F.date_trunc("day", "ts").alias("started_at"),
    )
    ended = completion_stream(events, done_statuses=["ready"], max_wait_seconds=12 * 3600.0)
    return _drain(ended, "completions").select(
        "subject_id", "outcome", "status",
        F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ended_at"),
    )


@query(
    "t2_readiness_stream",
    sql("""SELECT c_nationkey::BIGINT AS set_id, count(r.subject_id) AS ready, count(*) AS requested,
               count(r.subject_id) = count(*) AS all_ready
        FROM customer LEFT JOIN (SELECT DISTINCT subject_id FROM status_events WHERE status = 'ready') r
             ON r.subject_id = c_custkey GROUP BY 1"""),
)
def set_readiness(spark: SparkSession, sf: str) -> DataFrame:
    seen = ready_documents_stream(_event_stream(spark, sf), watermark="60 days")
    table = _drain(seen.withColumn("ready_at", F.col("ready_at")), "ready")
    wanted = t.load(spark, sf, "customer").select(
        F.col("c_nationkey").cast("long").alias("set_id"), F.col("c_custkey").alias("document_id")
    )
    ready = spark.readStream.schema(table.schema).parquet(table.inputFiles()[0].rsplit("/", 1)[0])
    root = scratch_path(spark, "readiness")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table")

    progress = set_readiness_stream(ready, wanted)
    running = (
        progress.writeStream.outputMode("complete").foreachBatch(keep)
        .option("checkpointLocation", root + "/progress").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return complete_readiness(spark.read.parquet(f"{root}/table"), wanted).select("set_id", "ready", "requested", "all_ready")


@query(
    "t4_unknown_status_stream",
    sql("""SELECT DISTINCT subject_id, status FROM status_events
        WHERE status NOT IN ('uploading', 'processing', 'ready')"""),
)
def unknown_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = unknown_status_stream(_event_stream(spark, sf), "document", watermark="60 days")
    return _drain(found, "unknown")


@query("t5_first_request_stream", sql("""SELECT key, request_id FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, request_id) AS place
        FROM requests) WHERE place = 1"""))
def first_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = _event_stream(spark, sf).select(
        F.concat_ws("-", "subject_id", "event_type").alias("key"),
        F.md5("props").alias("payload_hash"), "ts", F.col("event_id").alias("request_id"),
    )
    return _drain(first_requests_stream(requests, retention="60 days"), "requests").select("key", "request_id")


@query(
    "t7_continuous_ingest",
    """SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY 1""",
)
def continuous_ingest(spark: SparkSession, sf: str) -> DataFrame:
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "ingested")
    t.load(spark, sf, "documents").select("text", "lang").write.partitionBy("lang").text(inbox)
    running = ingest_stream(
        spark, inbox, t.held(spark, sf), out, base_key="live", flatten=False
    )
    running.awaitTermination()
    loaded = spark.read.parquet(out + "/outcomes").where("uploaded")
    lang = F.regexp_extract("path", "lang=([a-z]+)", 1)
    return loaded.groupBy(lang.alias("lang")).agg(F.sum("size").alias("bytes"))


@query(
    "t7_ingested_files",
    """SELECT 'lang=' || lang AS folder, md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS md5,
              CAST(0 AS INTEGER) AS epoch, true AS uploaded FROM documents GROUP BY 1
       UNION ALL
       SELECT 'source=' || source, md5(string_agg(text || chr(10), '' ORDER BY doc_id)), 1, true
       FROM documents GROUP BY 1""",
)
def ingested_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two micro-batches, a file per language and then a file per source: md5 and outcome of each."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "ingested")
    docs = t.load(spark, sf, "documents").select("text", "lang", "source", "doc_id")
    for key in ("lang", "source"):
        write_text_per_key(docs, key, "doc_id", inbox, "texts.txt")
        ingest_stream(spark, inbox, t.held(spark, sf), out, base_key="live", flatten=False).awaitTermination()
    outcomes = spark.read.parquet(out + "/outcomes")
    folder = F.substring_index("rel_path", "/", 1).alias("folder")
    return outcomes.select(folder, "md5", F.col("epoch").cast("int").alias("epoch"), "uploaded")
