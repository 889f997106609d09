"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Partitions of (id, fingerprint) send each owner of a hash range their sorted, distinct
hashes as Rice-coded gaps; owners answer with one bit per hash: seen elsewhere or more
than once.  Only texts whose bit is set are shuffled, and grouped by their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import ascii_lower, kept_rows
from docloom.session import materialize

#: Fingerprint bits above log2(rows): about one false suspect in 2**16 rows.
SPARE_BITS = 16
#: Most bits of the filter that finds suspects in the scan; one bit array of at most 1 MiB.
MOST_FILTER_BITS = 1 << 23


def rice_encode(values: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """Sorted distinct uint64 values as (count, parameter, unary quotients, remainders) of their gaps."""
    n = len(values)
    if not n:
        return 0, 0, b"", b""
    gaps = np.diff(values, prepend=np.uint64(0))
    k = max(0, int(math.log2(max(1.0, float(values[-1]) / n))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return n, k, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def rice_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The values that ``rice_encode`` took."""
    if not n:
        return np.zeros(0, np.uint64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k).astype(np.uint64)
        gaps += (bits << np.arange(k - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _split(fingerprints: np.ndarray, owners: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(owner, sorted distinct fingerprints relative to the owner's range, their counts)."""
    values, counts = np.unique(fingerprints.view(np.uint64), return_counts=True)
    span = np.uint64(-(-(1 << width) // owners))
    owner = values // span
    starts = np.flatnonzero(np.diff(owner, prepend=np.uint64((1 << 64) - 1)))
    for begin, end in zip(starts, [*starts[1:], len(values)], strict=True):
        yield int(owner[begin]), values[begin:end] - owner[begin] * span, counts[begin:end]


def _flags(bits: np.ndarray) -> bytes:
    return np.packbits(bits.astype(np.uint8)).tobytes()


def suspects(prints: DataFrame, rows: int) -> DataFrame:
    """The rows of ``prints`` (id, part, fingerprint) whose fingerprint another row has too.

    ``prints`` has fingerprints below ``2**(log2(rows) + SPARE_BITS)``.  A part holds
    about ``16 * sqrt(rows)`` rows, so messages between parts and owners stay fewer
    than rows; equal hashes of a part travel once, so a hot text costs one hash a part.
    """
    owners, width = _shape(rows)

    def send(frame: pd.DataFrame) -> pd.DataFrame:
        part, out = int(frame["part"].iloc[0]), []
        for owner, values, counts in _split(frame["fingerprint"].to_numpy(), owners, width):
            n, k, unary, rest = rice_encode(values)
            out.append((owner, part, n, k, unary, rest, _flags(counts > 1)))
        return pd.DataFrame(out, columns=["owner", "part", "n", "k", "unary", "rest", "repeated"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        sent = [rice_decode(m.n, m.k, m.unary, m.rest) for m in frame.itertuples()]
        own = [np.unpackbits(np.frombuffer(m.repeated, np.uint8))[: m.n].astype(bool) for m in frame.itertuples()]
        values, inverse, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        again = (counts > 1)[inverse] | np.concatenate(own)
        ends = np.cumsum([len(x) for x in sent])[:-1]
        bitmaps = [_flags(x) for x in np.split(again, ends)]
        return pd.DataFrame({"owner": frame["owner"], "part": frame["part"], "bitmap": bitmaps})

    def mark(mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return mine[["fingerprint"]]
        bitmaps = dict(zip(answers["owner"], answers["bitmap"], strict=True))
        found = []
        span = np.uint64(-(-(1 << width) // owners))
        for owner, values, _ in _split(mine["fingerprint"].to_numpy(), owners, width):
            bits = np.unpackbits(np.frombuffer(bitmaps[owner], np.uint8))[: len(values)].astype(bool)
            found.append(values[bits] + np.uint64(owner) * span)
        return pd.DataFrame({"fingerprint": np.concatenate(found).view(np.int64)})

    by_part = prints.select("part", "fingerprint").groupBy("part")
    messages = by_part.applyInPandas(
        send, "owner int, part int, n int, k int, unary binary, rest binary, repeated binary"
    )
    bitmaps = messages.groupBy("owner").applyInPandas(answer, "owner int, part int, bitmap binary")
    return by_part.cogroup(bitmaps.groupBy("part")).applyInPandas(mark, "fingerprint long")


def _shape(rows: int) -> tuple[int, int]:
    """Parts (as many owners) and fingerprint bits for so many rows."""
    parts = max(1, math.ceil(rows / (16 * math.sqrt(rows)))) if rows else 1
    return parts, min(62, max(1, math.ceil(math.log2(max(2, rows))) + SPARE_BITS))


def _is_suspect(fingerprint: Column, found: DataFrame, bits: int) -> Column:
    """A condition on a fingerprint: its bit is set in a filter made of all suspects' fingerprints."""
    slot = F.pmod(F.col("fingerprint"), F.lit(bits))
    words = (
        found.groupBy((slot / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("mask"))
        .collect()
    )
    masks = [0] * -(-bits // 64)
    for row in words:
        masks[row["word"]] = row["mask"]
    table = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
    asked = F.pmod(fingerprint, F.lit(bits))
    word = F.element_at(table, (asked / 64).cast("int") + 1)
    return F.call_function("shiftright", word, (asked % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Classes of equal texts: one row per row of ``docs`` (runs jobs).

    Returns doc_id, keep_id, group_size, kept, text_sha256.  Texts are equal when they
    are the same bytes after lower-casing A-Z; null counts as the empty text, and empty
    texts form a class like any other.  The largest id of a class stays.  Repeated rows
    (same id and text) count each in ``group_size`` and share one ``kept``.  A null id is
    never the largest; in a class of null ids only, ``keep_id`` is null and all stay.
    Other columns of ``docs`` are not read.  An empty table gives no rows.

    Texts are hashed in the scan.  What moves is narrow, but for the texts that have a
    copy; those are combined by their bytes before the shuffle, so a text that fills a
    third of the table moves once per task.
    """
    text = ascii_lower(F.col(text_column))
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("hash"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    stored = materialize(narrow, "fingerprints")
    rows = stored.count()
    parts, width = _shape(rows)

    def fingerprint(hashed: Column) -> Column:
        return F.shiftrightunsigned(hashed, 64 - width)

    part = F.pmod(F.xxhash64("doc_id", "hash", F.lit(parts)), F.lit(parts)).cast("int")
    prints = stored.select(part.alias("part"), fingerprint(F.col("hash")).alias("fingerprint"))
    found = materialize(suspects(prints, rows), "suspects")
    bits = 1 << 10
    while bits < min(MOST_FILTER_BITS, 16 * found.count()):
        bits *= 2
    suspected = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
    suspected = suspected.where(_is_suspect(fingerprint(F.xxhash64("text")), found, bits))
    groups = (
        suspected.groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.unhex(F.sha2("text", 256)).alias("digest"), "keep_id", "n")
    )
    joined = stored.join(groups, "digest", "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class of equal texts, that of the largest id; all columns stay (runs jobs).

    Rows go by id and text, so an id that repeats with another text keeps that one.  Of
    rows that share both, the least as JSON stays.  A class without any id leaves one row.
    """
    keyed = docs.withColumn("__digest", F.unhex(F.sha2(ascii_lower(F.col(text_column)), 256)))
    classes = exact_duplicates(docs, id_column, text_column)
    copies = classes.where("group_size > 1").select("doc_id", F.unhex("text_sha256").alias("__digest"), "kept")
    marks = copies.groupBy("doc_id", "__digest").agg(F.bool_or("kept").alias("stays"), F.count("*").alias("n"))
    return kept_rows(keyed, materialize(marks.where("not stays or n > 1"), "copies"), id_column)
