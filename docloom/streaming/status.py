"""Waiting as streams: completions with deadline, readiness, unknown statuses.

Input streams are status observations ``subject_id, status, ts``.  Each function
returns a streaming DataFrame; the caller picks sink, trigger and checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docloom.functions.enums import (
    DOCUMENT_STATUSES,
    JOB_STATUSES,
    TERMINAL_JOB_STATUSES,
    is_ready,
)
from docloom.operators.waits import JOB_WAIT_SECONDS, has_deadline
from docloom.streaming.combine import bucket_of, earliest_rows, plain_values

#: Tasks that the repeats of one hot key are spread over before the last step.
SALTS = 16


def first_per_key(stream: DataFrame, keys: Sequence[str], *, salts: int = SALTS) -> DataFrame:
    """One row per key within the watermark, the first one processed.

    The first step removes repeats per key and salt, so a key with very many rows
    is worked on by several tasks; at most ``salts`` rows of it reach the second.
    """
    salted = stream.withColumn("__salt", F.pmod(F.xxhash64(*stream.columns), F.lit(salts)))
    once = salted.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return once.dropDuplicatesWithinWatermark(list(keys))


def completion_stream(
    events: DataFrame,
    *,
    done_statuses: Sequence[str] = TERMINAL_JOB_STATUSES,
    max_wait_seconds: float | None = JOB_WAIT_SECONDS,
    watermark: str = "10 minutes",
    retention_seconds: float = 86_400.0,
) -> DataFrame:
    """Emit each wait once: ``subject_id, outcome, status, ended_at``.

    ``events`` also has ``started_at``, the start of the subject's wait.  The
    outcome is ``done`` for a done status up to and including the deadline, else
    ``timeout`` once the watermark has passed it.  Of the observations of one
    micro-batch the earliest done one counts.  A finished wait is remembered
    for ``retention_seconds`` of event time, so repeats do not emit again.  The state is
    kept per bucket of subjects, so that a call of the step serves many of them.
    """
    timed = has_deadline(max_wait_seconds)
    budget_ms = int(max_wait_seconds * 1000) if timed else 0
    keep_ms = int(retention_seconds * 1000)

    done = F.col("status").isin(*done_statuses)
    start_ms = F.unix_millis("started_at")
    ts_us = F.unix_micros("ts")
    if timed:
        done = done & (ts_us <= (start_ms + budget_ms) * 1000)
    shaped = events.select(
        "subject_id",
        "ts",
        F.when(done, F.col("status")).alias("done_status"),
        F.when(done, ts_us).alias("ts_us"),
        start_ms.alias("start_ms"),
    )
    # Of a subject's rows a task keeps the earliest done one, or any: a hot subject is a row per task.
    shaped = earliest_rows(shaped, "subject_id", ["ts_us"], "ts").withWatermark("ts", watermark)
    columns = ["subject_id", "start_ms", "done_status", "ts_us"]

    def step(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        # subject -> is it finished, its deadline, when it is looked at again
        waits = dict(zip((rows := state.get)[0], zip(*rows[1:], strict=True), strict=True)) if state.exists else {}
        ended: list[tuple] = []
        seen: dict[object, tuple[int | None, int | None, str | None]] = {}
        for frame in () if state.hasTimedOut else frames:
            subjects = plain_values(frame["subject_id"], missing=key[0] is None)
            for subject, start, status, us in zip(subjects, *(frame[c].tolist() for c in columns[1:]), strict=True):
                if subject in seen:
                    deadline, first, name = seen[subject]
                else:
                    first = name = None
                    deadline = waits[subject][1] if subject in waits else None
                    if timed and deadline is None:
                        deadline = int(start) + budget_ms
                if isinstance(status, str) and (first is None or us < first):
                    first, name = int(us), status
                seen[subject] = deadline, first, name
        for subject, (deadline, first, name) in seen.items():
            finished = subject in waits and waits[subject][0]
            if finished:
                waits[subject] = True, deadline, mark + keep_ms
            elif first is not None:
                waits[subject] = True, deadline, max(mark, first // 1000) + keep_ms
                ended.append((subject, "done", name, first))
            elif timed and deadline <= mark:
                waits[subject] = True, deadline, mark + keep_ms
                ended.append((subject, "timeout", None, deadline * 1000))
            else:
                waits[subject] = False, deadline, deadline
        # Subjects without rows whose time has come: a wait ends, a finished one is forgotten.
        due = [s for s, (_, _, until) in waits.items() if until is not None and until < mark and s not in seen]
        for subject in due:
            finished, deadline, _ = waits.pop(subject)
            if not finished:
                waits[subject] = True, deadline, mark + keep_ms
                ended.append((subject, "timeout", None, deadline * 1000))
        if waits:
            state.update((list(waits), *map(list, zip(*waits.values(), strict=True))))
            times = [until for _, _, until in waits.values() if until is not None]
            if times:
                state.setTimeoutTimestamp(min(times))
        else:
            state.remove()
        if ended:
            names = ["subject_id", "outcome", "status", "ended_us"]
            yield pd.DataFrame({name: list(values) for name, values in zip(names, zip(*ended, strict=True), strict=True)})

    key_type = events.schema["subject_id"].dataType.simpleString()
    out = shaped.withColumn("__bucket", bucket_of("subject_id")).groupBy("__bucket").applyInPandasWithState(
        step,
        f"subject_id {key_type}, outcome string, status string, ended_us long",
        f"subjects array<{key_type}>, finished array<boolean>, deadline_ms array<long>, until_ms array<long>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(
        "subject_id", "outcome", "status", F.timestamp_micros("ended_us").alias("ended_at")
    )


def ready_documents_stream(events: DataFrame, *, watermark: str = "10 minutes") -> DataFrame:
    """Each document once, when it is first seen ready."""
    ready = events.where(is_ready(F.col("status"))).withWatermark("ts", watermark)
    return first_per_key(ready, ["subject_id"]).select(
        F.col("subject_id").alias("document_id"), F.col("ts").alias("ready_at")
    )


def set_readiness_stream(ready: DataFrame, wanted: DataFrame) -> DataFrame:
    """Progress per document set out of a stream of ready documents, each there once.

    ``ready`` is what :func:`ready_documents_stream` wrote, read as a stream, and
    ``wanted`` the table ``set_id, document_id``.  Use update or complete mode: a
    set's row is all-ready from the batch on in which its last document arrived.
    """
    members = wanted.distinct()
    sizes = members.groupBy("set_id").agg(F.count("*").alias("requested"))
    counts = ready.join(members, "document_id").groupBy("set_id").agg(
        F.count("*").alias("ready"), F.max("ready_at").alias("last_ready_at")
    )
    joined = counts.join(sizes, "set_id")
    return joined.withColumn("all_ready", F.col("ready") == F.col("requested"))


def complete_readiness(progress: DataFrame, wanted: DataFrame) -> DataFrame:
    """The table that :func:`set_readiness_stream` wrote, with the sets that have nothing ready yet.

    A stream has no row for what has not arrived; this joins the requested sets to it.
    """
    sizes = wanted.distinct().groupBy("set_id").agg(F.count("*").alias("requested"))
    seen = progress.select("set_id", "ready", "last_ready_at")
    joined = sizes.join(seen, "set_id", "left").na.fill(0, ["ready"])
    return joined.withColumn("all_ready", F.col("ready") == F.col("requested"))


def unknown_status_stream(
    events: DataFrame, kind: str = "job", *, watermark: str = "10 minutes"
) -> DataFrame:
    """Each unknown status once per subject."""
    known = {"job": JOB_STATUSES, "document": DOCUMENT_STATUSES}[kind]
    strange = events.where(F.col("status").isNotNull() & ~F.col("status").isin(*known))
    once = first_per_key(strange.withWatermark("ts", watermark), ["subject_id", "status"])
    return once.select("subject_id", "status")
