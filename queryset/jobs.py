"""Jobs, cost, waits, replay in batch form, end to end (J, T3-T6, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import jobs as j
from docloom.operators import replay, waits
from docloom.operators.selectors import (
    Catalog, combine, of_class, paged_between, select_documents, touched_by,
)
from docloom.plans.extract import ExtractResult, extract, uncovered_files
from queryset import tables as t
from queryset.extraction import stored_results
from queryset.registry import query
from queryset.tables import sql

_RATES = {"splitter": 1, "classifier": 2, "extractor": 3}


@query(
    "j1_quote",
    sql("""SELECT CAST(sum(page_count) * 3 * 2 AS BIGINT) AS total_credits,
               CAST(sum(page_count) AS BIGINT) AS page_count, count(*) AS document_count
        FROM parts WHERE document_class = 'ECONOMY'"""),
)
def quote(spark: SparkSession, sf: str) -> DataFrame:
    chosen = select_documents(t.catalog_of_parts(spark, sf), combine([of_class(["ECONOMY"])]))
    return j.quote(chosen, "extractor", prompts=[1, 2], rates=_RATES)


def _requests() -> list[j.JobRequest]:
    economy, promo = combine([of_class(["ECONOMY"])]), combine([of_class(["PROMO"])])
    return [
        j.JobRequest("extractor", economy, prompts=(1, 2), max_credits=10),
        j.JobRequest("splitter", promo, max_credits=10**12),
        j.JobRequest("classifier", combine([paged_between(high=9)])),
        j.JobRequest("classifier", combine([touched_by([1, 2, 3])]), project_id=7),
    ]


_ESTIMATES = """
  SELECT 'extractor' AS step, CAST(coalesce(sum(page_count), 0) * 6 AS BIGINT) AS total_credits,
         count(*) AS document_count, CAST(10 AS BIGINT) AS max_credits FROM parts WHERE document_class = 'ECONOMY'
  UNION ALL SELECT 'splitter', CAST(coalesce(sum(page_count), 0) AS BIGINT), count(*), 1000000000000
  FROM parts WHERE document_class = 'PROMO'
  UNION ALL SELECT 'classifier', CAST(coalesce(sum(page_count), 0) * 2 AS BIGINT), count(*), NULL
  FROM parts WHERE page_count <= 9
  UNION ALL SELECT 'classifier', CAST(coalesce(sum(page_count), 0) * 2 AS BIGINT), count(*), NULL
  FROM parts WHERE id IN (SELECT document_id FROM job_documents WHERE job_id IN (1, 2, 3))"""


@query("j2_estimates", sql(f"SELECT step, total_credits, document_count FROM ({_ESTIMATES})"))
def estimates(spark: SparkSession, sf: str) -> DataFrame:
    priced = j.estimate(t.catalog_of_parts(spark, sf), _requests(), rates=_RATES)
    return priced.estimates.select("step", "total_credits", "document_count")


@query(
    "j3_budget_gate",
    sql(f"""SELECT step, total_credits, max_credits, coalesce(total_credits <= max_credits, true) AS admitted
        FROM ({_ESTIMATES})"""),
)
def budget_gate(spark: SparkSession, sf: str) -> DataFrame:
    priced = j.estimate(t.catalog_of_parts(spark, sf), _requests(), rates=_RATES)
    return j.budget_gate(priced.estimates).select("step", "total_credits", "max_credits", "admitted")


@query(
    "j4_started_jobs",
    sql(f"""SELECT step, document_count AS total_docs, total_credits AS credits, 'running' AS status,
            (SELECT max(id) FROM jobs) AS first_free, true AS fresh
        FROM ({_ESTIMATES}) WHERE coalesce(total_credits <= max_credits, true)"""),
)
def started_jobs(spark: SparkSession, sf: str) -> DataFrame:
    before = t.jobs(spark, sf)
    started = j.run_jobs(t.catalog_of_parts(spark, sf), _requests(), rates=_RATES, jobs=before)
    highest = F.lit(before.agg(F.max("id")).first()[0]).cast("long")
    many = started.jobs.count()
    fresh = F.col("id").between(highest + 1, highest + many)
    return started.jobs.select(
        F.col("stages")[0].alias("step"), "total_docs", "credits", "status", highest.alias("first_free"), fresh.alias("fresh")
    )


@query(
    "j5_run_job_documents",
    sql("""SELECT id AS document_id, 'running' AS status FROM parts WHERE document_class = 'PROMO'
        UNION ALL SELECT id, 'running' FROM parts WHERE page_count <= 9
        UNION ALL SELECT id, 'running' FROM parts
        WHERE id IN (SELECT document_id FROM job_documents WHERE job_id IN (1, 2, 3))"""),
)
def run_job_documents(spark: SparkSession, sf: str) -> DataFrame:
    started = j.run_jobs(t.catalog_of_parts(spark, sf), _requests(), rates=_RATES)
    return started.job_documents.select("document_id", "status")


@query(
    "j6_status_roll_up",
    sql("""SELECT j.id AS job_id, count(d.document_id) AS total_docs,
            count(*) FILTER (WHERE d.status = 'completed') AS completed_docs, count(*) FILTER (WHERE d.status = 'failed') AS error_count,
            CASE WHEN count(*) FILTER (WHERE d.status = 'running') > 0 THEN 'running'
                 WHEN count(*) FILTER (WHERE d.status = 'failed') = 0 THEN 'completed'
                 WHEN count(*) FILTER (WHERE d.status = 'completed') = 0 THEN 'failed' ELSE 'partial_success' END AS status
        FROM jobs j LEFT JOIN job_documents d ON d.job_id = j.id GROUP BY 1"""),
)
def status_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    return j.roll_up_status(t.job_documents(spark, sf), t.jobs(spark, sf))


@query(
    "j7_job_results",
    sql("""SELECT d.id, r.prompt_id, r.raw_value FROM docs d
        LEFT JOIN results r ON r.document_id = d.id AND r.prompt_id IN (1, 2, 3)
        WHERE d.id IN (SELECT document_id FROM job_documents WHERE job_id BETWEEN 1 AND 12)"""),
)
def job_results(spark: SparkSession, sf: str) -> DataFrame:
    catalog = Catalog(t.docs(spark, sf), job_documents=t.job_documents(spark, sf))
    rows = j.job_results(catalog, list(range(1, 13)), stored_results(spark, sf), [1, 2, 3])
    return rows.select("id", "prompt_id", "raw_value")


@query(
    "j8_terminal_jobs",
    sql("SELECT id, status, status IN ('completed', 'partial_success') AS is_terminal FROM jobs"),
)
def terminal(spark: SparkSession, sf: str) -> DataFrame:
    return j.with_terminal_flag(t.jobs(spark, sf)).select("id", "status", "is_terminal")


_LATEST = """(SELECT subject_id, status FROM (SELECT *, row_number() OVER (
     PARTITION BY subject_id ORDER BY ts DESC, status DESC) AS rn FROM status_events) WHERE rn = 1)"""


@query(
    "j8_latest_status",
    sql(f"SELECT subject_id, status, false AS is_done FROM {_LATEST}"),
)
def latest(spark: SparkSession, sf: str) -> DataFrame:
    return waits.job_wait_state(t.status_events(spark, sf)).select("subject_id", "status", "is_done")


_WANTED = "(SELECT c_nationkey AS set_id, c_custkey AS document_id FROM customer)"


@query(
    "j9_readiness",
    sql(f"""SELECT CAST(set_id AS BIGINT) AS set_id, count(*) AS requested,
               count(*) FILTER (WHERE coalesce(status = 'ready', false)) AS ready, count(*) FILTER (WHERE status IS NULL) AS missing,
               bool_and(coalesce(status = 'ready', false)) AS all_ready
        FROM {_WANTED} w LEFT JOIN {_LATEST} e ON e.subject_id = w.document_id GROUP BY 1"""),
)
def readiness(spark: SparkSession, sf: str) -> DataFrame:
    wanted = t.load(spark, sf, "customer").select(
        F.col("c_nationkey").cast("long").alias("set_id"), F.col("c_custkey").alias("document_id")
    )
    return waits.readiness(wanted, t.status_events(spark, sf))


@query(
    "j9_all_ready",
    sql(f"""SELECT count(*) AS requested, count(*) FILTER (WHERE status = 'ready') AS ready,
               coalesce(bool_and(status = 'ready'), true) AS all_ready
        FROM (SELECT DISTINCT subject_id FROM status_events WHERE status = 'ready')
        JOIN {_LATEST} USING (subject_id)"""),
)
def all_ready(spark: SparkSession, sf: str) -> DataFrame:
    events = t.status_events(spark, sf)
    return waits.all_ready(events.where("status = 'ready'").select("subject_id"), events)


@query(
    "t3_wait_deadlines",
    sql("""SELECT w.subject_id, CASE WHEN e.ts <= w.started_at + INTERVAL 12 HOUR THEN 'done'
               ELSE 'timeout' END AS outcome,
               CASE WHEN e.ts <= w.started_at + INTERVAL 12 HOUR
                    THEN strftime(greatest(e.ts, w.started_at), '%Y-%m-%d %H:%M:%S') END AS ended_at
        FROM (SELECT subject_id, date_trunc('day', min(ts)) AS started_at FROM status_events GROUP BY 1) w
        LEFT JOIN (SELECT subject_id, min(ts) AS ts FROM status_events WHERE status = 'ready' GROUP BY 1) e
             ON e.subject_id = w.subject_id"""),
)
def wait_deadlines(spark: SparkSession, sf: str) -> DataFrame:
    events = t.status_events(spark, sf)
    opened = events.groupBy("subject_id").agg(F.date_trunc("day", F.min("ts")).alias("started_at"))
    ended = waits.wait_outcomes(
        opened, events, done=F.col("status") == "ready", max_wait_seconds=12 * 3600.0
    )
    return ended.select(
        "subject_id", "outcome", F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss").alias("ended_at")
    )


@query(
    "t4_unknown_statuses",
    sql("""SELECT DISTINCT subject_id, status FROM status_events
        WHERE status NOT IN ('uploading', 'processing', 'ready')"""),
)
def unknown(spark: SparkSession, sf: str) -> DataFrame:
    return waits.unknown_statuses(t.status_events(spark, sf), "document")


_REPLAYED = """(SELECT *, first_value(request_id) OVER w AS first_id, first_value(payload_hash) OVER w AS first_hash
     FROM requests WINDOW w AS (PARTITION BY key ORDER BY ts, request_id))"""


@query(
    "t5_replayed_requests",
    sql(f"""SELECT key, request_id, CASE WHEN request_id = first_id THEN 'executed'
               WHEN payload_hash = first_hash THEN 'replayed' ELSE 'rejected' END AS outcome,
               CASE WHEN payload_hash = first_hash THEN first_id END AS answered_by FROM {_REPLAYED}"""),
)
def replayed(spark: SparkSession, sf: str) -> DataFrame:
    return replay.replay_requests(t.requests(spark, sf)).select(
        "key", "request_id", "outcome", "answered_by"
    )


@query(
    "t6_misused_keys",
    sql(f"""SELECT key, count(*) AS requests, count(*) FILTER (WHERE payload_hash <> first_hash) AS rejected
        FROM {_REPLAYED} GROUP BY 1 HAVING count(*) FILTER (WHERE payload_hash <> first_hash) > 0"""),
)
def misused(spark: SparkSession, sf: str) -> DataFrame:
    return replay.misused_keys(t.requests(spark, sf))


# ----- end to end --------------------------------------------------------------------

_E_RULES = [t.RULES[0], t.RULES[1], t.RULES[2]]
_E_DOCS = "(SELECT DISTINCT document_id, text FROM (SELECT o.document_id, CASE WHEN o.holder_id IS NULL THEN o.text ELSE h.text END AS text FROM all_outcomes o LEFT JOIN held h ON h.id = o.holder_id))"


def _pipeline(spark: SparkSession, sf: str) -> ExtractResult:
    return extract(
        Catalog(t.held(spark, sf)), _E_RULES, files=t.incoming(spark, sf), rates=_RATES,
        spread=t.spread(spark),
    )


def _all_outcomes(body: str) -> str:
    base = sql("SELECT 1 FROM planned JOIN held ON true")
    view = """all_outcomes AS (SELECT p.*, h.id AS holder_id,
        coalesce(h.id, (SELECT max(id) FROM held) + 1 + p.ordinal) AS document_id
        FROM planned p LEFT JOIN held h ON h.name = p.file_name)"""
    return base[: base.rindex(" SELECT 1")] + ", " + view + " " + body


def _hits(prompt: int) -> str:
    rule = t.RULES[prompt - 1]
    return f"""SELECT document_id, '{rule.name}' AS field_key,
        nullif(regexp_extract(text, '{rule.pattern}'), '') AS value FROM {_E_DOCS}"""


_E_VALUES = " UNION ALL ".join(f"SELECT * FROM ({_hits(p)}) WHERE value IS NOT NULL" for p in (1, 2, 3))


@query(
    "e1_extract_values",
    _all_outcomes(f"""SELECT d.document_id, v.field_key, v.value FROM {_E_DOCS} d
        LEFT JOIN ({_E_VALUES}) v ON v.document_id = d.document_id"""),
)
def extract_values(spark: SparkSession, sf: str) -> DataFrame:
    return _pipeline(spark, sf).values.select("document_id", "field_key", "value")


@query(
    "e1_extract_job",
    _all_outcomes(f"""SELECT count(*) AS total_docs, count(*) AS completed_docs, CAST(0 AS BIGINT) AS error_count,
               'completed' AS status FROM {_E_DOCS}"""),
)
def extract_job(spark: SparkSession, sf: str) -> DataFrame:
    return _pipeline(spark, sf).job.select("total_docs", "completed_docs", "error_count", "status")


@query(
    "e2_uncovered_files",
    _all_outcomes(f"""SELECT file_name, document_id,
          CASE WHEN holder_id IS NOT NULL THEN 'NAME_ALREADY_EXISTS' ELSE 'no_values' END AS reason
        FROM all_outcomes WHERE holder_id IS NOT NULL
           OR document_id NOT IN (SELECT document_id FROM ({_E_VALUES}))"""),
)
def uncovered(spark: SparkSession, sf: str) -> DataFrame:
    out = _pipeline(spark, sf)
    return uncovered_files(out.outcomes, out.values)
