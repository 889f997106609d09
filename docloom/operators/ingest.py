"""Ingest steps: names, batches, ledger, duplicates, conflicts, outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.enums import DUPLICATE_POLICIES
from docloom.functions.names import guess_content_type
from docloom.operators.joins import settled
from docloom.operators.ordinals import with_dense_ordinal

#: Fixed limit of files in one batch.
MAX_BATCH_FILES = 100


# ----- names and batches -----------------------------------------------------------


def with_remote_name(files: DataFrame, *, flatten: bool, path_col: str = "path") -> DataFrame:
    """Add ``file_name``: the basename when flattening, else the path as it is given.

    For a directory pass its relative path column, so that the layout is kept.
    """
    path = F.col(path_col)
    return files.withColumn("file_name", F.substring_index(path, "/", -1) if flatten else path)


def repeated_names(files: DataFrame) -> DataFrame:
    """Names that occur more than once in the whole set: ``file_name, files``."""
    counts = files.groupBy("file_name").agg(F.count("*").alias("files"))
    return counts.where(F.col("files") > 1)


def require_unique_names(files: DataFrame) -> DataFrame:
    """Raise when flattened names repeat (runs a job); the error says how many and shows the first ones."""
    bad = repeated_names(files)
    total = bad.count()
    if total:
        shown = ", ".join(row["file_name"] for row in bad.orderBy("file_name").limit(20).collect())
        raise ValueError(
            f"{total} flattened file names repeat (repeated_names lists all): {shown}"
            f"{', ...' if total > 20 else ''}; keep the paths instead"
        )
    return files


def with_content_type(files: DataFrame, override: str | None = None) -> DataFrame:
    return files.withColumn("content_type", guess_content_type(F.col("file_name"), override))


def plan_batches(
    files: DataFrame,
    base_key: str,
    *,
    order_by: Sequence[str | Column],
    batch_size: int = MAX_BATCH_FILES,
) -> DataFrame:
    """Add ``ordinal, batch_no, batch_key`` along a total order (runs a job).

    Same files, order, size and base key give the same batches again.
    """
    if not 1 <= batch_size <= MAX_BATCH_FILES:
        raise ValueError(f"batch_size must be between 1 and {MAX_BATCH_FILES}")
    numbered = with_dense_ordinal(files, order_by, "ordinal")
    number = F.floor(F.col("ordinal") / F.lit(batch_size)).cast("long")
    return numbered.withColumn("batch_no", number).withColumn(
        "batch_key", F.format_string(base_key.replace("%", "%%") + "-%04d", "batch_no")
    )


def batch_payloads(planned: DataFrame) -> DataFrame:
    """``batch_key, batch_no, files, payload_hash``; a batch holds at most 100 files."""
    entry = F.struct("ordinal", "file_name", "md5")
    lines = F.transform(
        F.array_sort(F.collect_list(entry)), lambda e: F.concat_ws(":", e["file_name"], e["md5"])
    )
    return planned.groupBy("batch_key", "batch_no").agg(
        F.count("*").alias("files"), F.md5(F.array_join(lines, "\n")).alias("payload_hash")
    )


@dataclass(frozen=True)
class Resumption:
    """``pending`` files still to load, ``conflicts`` batches whose key had other files."""

    pending: DataFrame
    conflicts: DataFrame


def resume_from_ledger(planned: DataFrame, ledger: DataFrame) -> Resumption:
    """Leave out batches that a ledger ``batch_key, payload_hash`` has as loaded."""
    payloads = batch_payloads(planned)
    # A ledger that was appended twice counts once.
    past = ledger.select("batch_key", F.col("payload_hash").alias("past_hash")).distinct()
    judged = payloads.join(past, "batch_key", "left")
    conflicts = judged.where(F.col("payload_hash") != F.col("past_hash")).select(
        "batch_key", "batch_no", "payload_hash", "past_hash"
    )
    pending = planned.join(past.select("batch_key").distinct(), "batch_key", "left_anti")
    return Resumption(pending, conflicts)


# ----- duplicates and conflicts ------------------------------------------------------


@dataclass(frozen=True)
class Duplicates:
    """Content matches, kept per md5 instead of per pair of files.

    ``files`` is the incoming set with ``duplicate_count`` and
    ``first_duplicate_id``; ``members`` lists the matched catalog documents once
    per md5.  Together they hold every match, and their size grows with the
    tables even when one content makes up a third of both.
    """

    files: DataFrame
    members: DataFrame


def match_duplicates(incoming: DataFrame, catalog: DataFrame) -> Duplicates:
    """Catalog documents with the same md5; incoming files are not matched to each other."""
    held = catalog.where(F.col("md5").isNotNull())
    per_content = held.groupBy("md5").agg(
        F.count("*").alias("duplicate_count"), F.min("id").alias("first_duplicate_id")
    )
    files = incoming.join(settled(per_content), "md5", "left").na.fill(0, ["duplicate_count"])
    keep = ["file_size", "page_count", "created_at"]
    members = held.join(settled(incoming.select("md5").distinct()), "md5", "left_semi").select(
        "md5",
        F.col("id").alias("document_id"),
        "name",
        *[c for c in keep if c in catalog.columns],
    )
    return Duplicates(files, members)


def upload_outcomes(
    files: DataFrame,
    catalog: DataFrame,
    *,
    first_id: int,
    on_duplicate: str = "allow",
    max_size: int | None = None,
) -> DataFrame:
    """What happens to each file: loaded, rejected, or skipped as a duplicate.

    ``files`` has ``ordinal, file_name, size, folder_id, duplicate_count`` and an
    optional ``has_file`` flag.  A name taken in its folder is rejected and
    carries the id of the document that holds it; a file above ``max_size`` is
    rejected without id.  Everything else gets ``first_id + ordinal``.  Under
    ``block`` a duplicate keeps that id in its outcome although the document is
    not made; an accepted item without a local file fails without an error.

    Names are unique per folder inside the set as well: of files for the same place the
    one of the smallest ordinal takes it, later ones are rejected and carry its id.  Too
    large files and blocked duplicates take no place.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {', '.join(DUPLICATE_POLICIES)}")
    folder, place_name = F.col("folder_id").alias("__folder"), F.col("name").alias("__name")
    holders = catalog.groupBy(folder, place_name).agg(F.min("id").alias("holder_id"))
    place = F.col("folder_id").eqNullSafe(F.col("__folder")) & (
        F.col("file_name") == F.col("__name")
    )
    rows = files.join(settled(holders), place, "left").drop("__folder", "__name")
    has_file = F.col("has_file") if "has_file" in files.columns else F.lit(True)

    limit = F.lit(max_size).cast("long")
    too_large = F.coalesce(F.col("size") > limit, F.lit(False))
    blocked = (F.col("duplicate_count") > 0) & F.lit(on_duplicate == "block")
    new_id = F.lit(first_id).cast("long") + F.col("ordinal")
    # What would be made, were it alone in the set; of each place the first one is.
    claims = rows.where(F.col("holder_id").isNull() & ~too_large & ~blocked)
    winners = claims.groupBy(F.col("folder_id").alias("__folder"), F.col("file_name").alias("__name")).agg(
        F.min(new_id).alias("winner_id")
    )
    rows = rows.join(settled(winners), place, "left").drop("__folder", "__name")
    taken = ~too_large & ~blocked & (F.col("winner_id") < new_id)
    clash = F.col("holder_id").isNotNull() | F.coalesce(taken, F.lit(False))
    slot = ~clash & ~too_large
    skipped = slot & blocked
    size = F.col("size").cast("long")

    def failure(code: str, message: str) -> Column:
        return F.struct(
            F.lit(code).alias("code"),
            F.lit(message).alias("message"),
            F.when(too_large, size).alias("file_size"),
            F.when(too_large, limit).alias("max_size"),
            F.lit(False).alias("retryable"),
        )

    error = F.when(
        clash, failure("NAME_ALREADY_EXISTS", "a document of this name is in the folder")
    ).when(too_large, failure("FILE_TOO_LARGE", "the file is above the size limit"))
    document_id = F.when(clash, F.coalesce("holder_id", "winner_id")).when(slot, new_id)
    return rows.withColumns(
        {
            "document_id": document_id,
            "uploaded": slot & ~skipped & has_file,
            "skipped_as_duplicate": skipped,
            "error": error,
        }
    ).drop("holder_id", "winner_id")


def duplicate_warnings(outcomes: DataFrame) -> DataFrame:
    """One row per loaded file that matches existing content (policy ``notify``)."""
    return outcomes.where(F.col("error").isNull() & (F.col("duplicate_count") > 0)).select(
        "file_name", "document_id", "md5", "duplicate_count", "first_duplicate_id"
    )


# ----- outcomes ------------------------------------------------------------------------


def _outcome_counts() -> list[Column]:
    uploaded, skipped = F.col("uploaded"), F.col("skipped_as_duplicate")
    return [
        F.count("*").alias("files"),
        F.count_if(uploaded).alias("succeeded"),
        F.count_if(~uploaded & ~skipped).alias("failed"),
        F.count_if(skipped).alias("skipped"),
        F.count("document_id").alias("document_ids"),
    ]


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """One row of counts; ``document_ids`` counts every id, also of rejected files."""
    return outcomes.agg(*_outcome_counts())


def batch_summaries(outcomes: DataFrame) -> DataFrame:
    """The same counts per batch."""
    return outcomes.groupBy("batch_no", "batch_key").agg(*_outcome_counts())


def document_ids(outcomes: DataFrame) -> DataFrame:
    """Every id the outcomes carry, including blocked placeholders and rejected files."""
    return outcomes.where(F.col("document_id").isNotNull()).select("document_id")


@dataclass(frozen=True)
class PartialRun:
    """Outcomes of the batches before the first failing one, and their number."""

    outcomes: DataFrame
    progress: DataFrame


def stop_at_first_failure(outcomes: DataFrame, failed_batches: DataFrame) -> PartialRun:
    """Keep what was loaded before the first failing batch; nothing is rolled back."""
    first_failed = failed_batches.agg(F.min("batch_no"))
    total = outcomes.agg(F.coalesce(F.max("batch_no") + 1, F.lit(0)))
    stop = F.coalesce(first_failed.scalar(), total.scalar())
    kept = outcomes.where(F.col("batch_no") < stop)
    progress = failed_batches.agg(F.min("batch_no").alias("failed_batch")).select(
        F.coalesce(F.col("failed_batch"), total.scalar()).cast("long").alias("batches_completed"),
        F.col("failed_batch").isNotNull().alias("stopped_early"),
    )
    return PartialRun(kept, progress)


def pin_project(outcomes: DataFrame, project_id: int, added_at: Column | None = None) -> DataFrame:
    """Membership rows of one project for every loaded document, whatever its batch."""
    return outcomes.where("uploaded").select(
        F.lit(project_id).cast("long").alias("project_id"),
        "document_id",
        (F.current_timestamp() if added_at is None else added_at).alias("created_at"),
    )


def pin_tags(batch_tags: DataFrame) -> DataFrame:
    """Union of the tags that batches report, by id; the later batch names a tag."""
    return batch_tags.groupBy("tag_id").agg(F.max_by("name", "batch_no").alias("name"))


def tag_documents(
    outcomes: DataFrame, tag_ids: Sequence[int], tagged_at: Column | None = None
) -> DataFrame:
    """``document_tags`` rows: every loaded document with every pinned tag id."""
    ids = F.array(*[F.lit(t).cast("long") for t in tag_ids]).cast("array<bigint>")
    return outcomes.where("uploaded").select(
        "document_id",
        F.explode(ids).alias("tag_id"),
        (F.current_timestamp() if tagged_at is None else tagged_at).alias("tagged_at"),
    )
