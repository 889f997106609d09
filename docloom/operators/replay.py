"""Keyed writes in batch form: first response per key, replays, misused keys.

Requests are ``key, payload_hash, ts, request_id`` plus any response columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.joins import settled

REPLAY_OUTCOMES = ("executed", "replayed", "rejected")


def first_requests(requests: DataFrame, *, key: str = "key") -> DataFrame:
    """The earliest request of each key; equal times go to the smaller request id."""
    others = [c for c in requests.columns if c not in (key, "ts", "request_id")]
    earliest = F.min_by(F.struct("ts", "request_id", *others), F.struct("ts", "request_id"))
    return requests.groupBy(key).agg(earliest.alias("first")).select(key, "first.*")


def replay_requests(requests: DataFrame, *, key: str = "key") -> DataFrame:
    """Every request with its ``outcome`` and the request that answers it.

    The first of a key is executed.  A later one with the same payload is
    replayed: ``answered_by`` names the first.  One with another payload is
    rejected and gets no answer.
    """
    first = first_requests(requests, key=key).select(
        key,
        F.col("request_id").alias("first_id"),
        F.col("payload_hash").alias("first_hash"),
    )
    # Many requests to one first request: the many side is the left, which
    # adaptive execution splits when a key is hot.
    joined = requests.join(settled(first), key, "left")
    same = F.col("payload_hash").eqNullSafe(F.col("first_hash"))
    outcome = (
        F.when(F.col("request_id") == F.col("first_id"), "executed")
        .when(same, "replayed")
        .otherwise("rejected")
    )
    answered = F.when(same, F.col("first_id"))
    return joined.withColumns({"outcome": outcome, "answered_by": answered}).drop(
        "first_id", "first_hash"
    )


def misused_keys(requests: DataFrame, *, key: str = "key") -> DataFrame:
    """Keys that were used with more than one payload, and how many rows differ.

    Counted per key and payload first, so a hot key is combined before its shuffle.
    """
    per_payload = requests.groupBy(key, "payload_hash").agg(
        F.count("*").alias("n"), F.min(F.struct("ts", "request_id")).alias("first")
    )
    return (
        per_payload.groupBy(key)
        .agg(
            F.sum("n").alias("requests"),
            (F.sum("n") - F.min_by("n", "first")).alias("rejected"),
        )
        .where(F.col("rejected") > 0)
    )
