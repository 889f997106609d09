"""Batch forms of waiting: latest status, readiness, deadlines, unknown values.

Each takes a table of status observations ``subject_id, status, ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.enums import DOCUMENT_STATUSES, JOB_STATUSES, is_ready, is_terminal
from docloom.operators.joins import settled

# Fixed wait budgets in seconds.
JOB_WAIT_SECONDS = 1800.0
DOCUMENT_WAIT_SECONDS = 600.0


def latest_status(events: DataFrame) -> DataFrame:
    """The newest status per subject; equal times go to the greater status text."""
    newest = F.max(F.struct("ts", "status")).alias("newest")
    return events.groupBy("subject_id").agg(newest).select(
        "subject_id", F.col("newest.status").alias("status"), F.col("newest.ts").alias("ts")
    )


def job_wait_state(events: DataFrame) -> DataFrame:
    """Latest status per job and whether a wait on it would return."""
    return latest_status(events).withColumn("is_done", is_terminal(F.col("status")))


def readiness(wanted: DataFrame, events: DataFrame) -> DataFrame:
    """Per document set: is every requested document there and ready?

    ``wanted`` is ``set_id, document_id``.  A document that was never seen is not
    ready.  A set that asks for nothing has no row; see :func:`all_ready`.
    """
    latest = latest_status(events).select(F.col("subject_id").alias("document_id"), "status")
    ready = is_ready(F.col("status"))
    return (
        wanted.distinct()
        .join(settled(latest), "document_id", "left")
        .groupBy("set_id")
        .agg(
            F.count("*").alias("requested"),
            F.count_if(ready).alias("ready"),
            F.count_if(F.col("status").isNull()).alias("missing"),
            F.bool_and(ready).alias("all_ready"),
        )
    )


def all_ready(document_ids: DataFrame, events: DataFrame) -> DataFrame:
    """One row ``requested, ready, all_ready`` for one set; the empty set is ready."""
    ids = document_ids.select(F.col(document_ids.columns[0]).alias("document_id")).distinct()
    latest = latest_status(events).select(F.col("subject_id").alias("document_id"), "status")
    ready = is_ready(F.col("status"))
    return ids.join(latest, "document_id", "left").agg(
        F.count("*").alias("requested"),
        F.count_if(ready).alias("ready"),
        F.coalesce(F.bool_and(ready), F.lit(True)).alias("all_ready"),
    )


def has_deadline(max_wait_seconds: float | None) -> bool:
    """None, zero and negative budgets mean waiting without a deadline."""
    return max_wait_seconds is not None and max_wait_seconds > 0


def wait_outcomes(
    waits: DataFrame,
    events: DataFrame,
    *,
    done: Column | None = None,
    max_wait_seconds: float | None = JOB_WAIT_SECONDS,
    observed_until: Column | None = None,
) -> DataFrame:
    """How each wait ends: ``done``, ``timeout`` or ``waiting``.

    ``waits`` is ``subject_id, started_at``.  The first observation for which
    ``done`` holds (terminal job status by default) is final for its subject.  It
    ends the wait, at once when it came before the start; one exactly at the
    deadline still wins.  Without one, the wait has timed out once
    ``observed_until`` (default: now) reaches the deadline.
    """
    finished = is_terminal(F.col("status")) if done is None else done
    # Reduced to one row per subject before the join, however many there were.
    ends = (
        events.where(finished)
        .groupBy("subject_id")
        .agg(F.min(F.struct("ts", "status")).alias("end"))
    )
    if has_deadline(max_wait_seconds):
        budget = F.make_dt_interval(secs=F.lit(max_wait_seconds).cast("decimal(18,6)"))
        deadline = F.col("started_at") + budget
    else:
        deadline = F.lit(None).cast("timestamp")
    now = F.current_timestamp() if observed_until is None else observed_until
    in_time = F.col("end").isNotNull() & (
        F.col("deadline").isNull() | (F.col("end.ts") <= F.col("deadline"))
    )
    outcome = (
        F.when(in_time, "done").when(F.col("deadline") <= now, "timeout").otherwise("waiting")
    )
    return (
        waits.withColumn("deadline", deadline)
        .join(settled(ends), "subject_id", "left")
        .select(
            "subject_id",
            "started_at",
            "deadline",
            outcome.alias("outcome"),
            F.when(in_time, F.col("end.status")).alias("status"),
            F.when(in_time, F.greatest("end.ts", "started_at")).alias("ended_at"),
        )
    )


def unknown_statuses(events: DataFrame, kind: str = "job") -> DataFrame:
    """Each unknown status once per subject: ``subject_id, status``."""
    known = {"job": JOB_STATUSES, "document": DOCUMENT_STATUSES}[kind]
    strange = events.where(F.col("status").isNotNull() & ~F.col("status").isin(*known))
    return strange.select("subject_id", "status").distinct()
