"""Bulk ingest as one plan: names, batches, resumption, duplicates, outcomes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import ingest as steps
from docloom.operators.folders import leaf_folders, resolve_folder_paths
from docloom.operators.joins import settled
from docloom.session import materialize


@dataclass(frozen=True)
class IngestResult:
    """Tables of one ingest run.

    ``outcomes`` one row per file, ``documents`` the new catalog rows,
    ``duplicates`` the matched catalog documents per md5, ``warnings`` loaded
    duplicates under ``notify``, ``batches`` counts per batch, ``ledger`` what to
    append once the documents are written, ``conflicts`` batches whose key was
    used before with other files.  ``folders`` (the whole tree) and ``created_folders`` are
    there when a layout was rebuilt.
    """

    outcomes: DataFrame
    documents: DataFrame
    duplicates: DataFrame
    warnings: DataFrame
    batches: DataFrame
    ledger: DataFrame
    conflicts: DataFrame
    folders: DataFrame | None = None
    created_folders: DataFrame | None = None


def with_layout(named: DataFrame, folders: DataFrame, parent_id: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files at their places: the folders of ``file_name`` below ``parent_id``, made where missing (runs jobs).

    ``file_name`` becomes the last component and ``folder_id`` the folder that holds it;
    a name without folders stays in ``parent_id``.  Returns files, all folders and the new ones.
    """
    above = F.regexp_extract("file_name", "^(.*)/[^/]*$", 1)
    split = named.withColumns({"__above": above, "file_name": F.substring_index("file_name", "/", -1)}).drop("folder_id")
    # Each folder is resolved once, however many files it gets.
    resolved = resolve_folder_paths(folders, split.select("__above").distinct(), path_col="__above", parent_id=parent_id)
    leaves = materialize(leaf_folders(resolved).select("__above", "leaf_id"), "layout")
    joined = split.join(settled(leaves), "__above", "left").drop("__above")
    placed = joined.withColumn("folder_id", F.coalesce("leaf_id", F.lit(parent_id).cast("long"))).drop("leaf_id")
    return placed, resolved.folders, resolved.created


def ingest_files(
    files: DataFrame,
    catalog: DataFrame,
    *,
    base_key: str,
    flatten: bool = True,
    path_col: str = "path",
    batch_size: int = steps.MAX_BATCH_FILES,
    on_duplicate: str = "allow",
    max_size: int | None = None,
    ledger: DataFrame | None = None,
    content_type: str | None = None,
    check_names: bool = True,
    first_id: int | None = None,
    folders: DataFrame | None = None,
    parent_id: int | None = None,
) -> IngestResult:
    """Plan the load of ``files`` (path, size, md5, folder_id) into ``catalog`` (runs jobs).

    With ``flatten=False`` and the ``folders`` table, the folders of a path are made below
    ``parent_id`` and the document gets its last component as name; ``folder_id`` of the
    files is not read then.  Without ``folders`` the whole path is the name.

    ``catalog`` has ``id, name, folder_id, md5``.  Ids of new documents follow the
    largest catalog id (or start at ``first_id``) in path order, so a rerun over the
    same tables gives the same ids; write the documents first, then append the ledger.
    """
    # Texts and other columns of the caller stay outside; what is sorted and written is narrow,
    # and hashes are computed once, before the sort samples its input.
    narrow = ["size", "md5", "folder_id", *[c for c in ("page_count", "has_file") if c in files.columns]]
    files = materialize(files.select(*dict.fromkeys(["path", path_col, *narrow])), "files")
    named = steps.with_remote_name(files, flatten=flatten, path_col=path_col)
    if flatten and check_names:
        steps.require_unique_names(named)
    tree = created = None
    if folders is not None and not flatten:
        named, tree, created = with_layout(named, folders, parent_id)
    typed = steps.with_content_type(named, content_type)
    order = [F.split(F.col(path_col), "/", -1)]
    planned = steps.plan_batches(typed, base_key, order_by=order, batch_size=batch_size)
    conflicts = steps.batch_payloads(planned).select(
        "batch_key", "batch_no", "payload_hash", F.lit(None).cast("string").alias("past_hash")
    ).limit(0)
    if ledger is not None:
        resumed = steps.resume_from_ledger(planned, ledger)
        planned, conflicts = resumed.pending, resumed.conflicts
    matched = steps.match_duplicates(planned, catalog)
    if first_id is None:
        first_id = (catalog.agg(F.max("id")).first()[0] or 0) + 1
    outcomes = materialize(
        steps.upload_outcomes(
            matched.files, catalog, first_id=first_id, on_duplicate=on_duplicate, max_size=max_size
        ),
        "outcomes",
    )
    documents = outcomes.where("uploaded").select(
        F.col("document_id").alias("id"),
        F.col("file_name").alias("name"),
        "folder_id",
        F.col("size").alias("file_size"),
        "content_type",
        "md5",
        F.lit("ready").alias("status"),
    )
    warnings = steps.duplicate_warnings(outcomes)
    if on_duplicate != "notify":
        warnings = warnings.limit(0)
    return IngestResult(
        outcomes=outcomes,
        documents=documents,
        duplicates=matched.members,
        warnings=warnings,
        batches=steps.batch_summaries(outcomes),
        ledger=steps.batch_payloads(outcomes).select("batch_key", "payload_hash"),
        conflicts=conflicts,
        folders=tree,
        created_folders=created,
    )


@dataclass(frozen=True)
class LoadRun:
    """One staged load, as published: what it wrote (``documents``, ``outcomes``, pins) and how far it came.

    ``progress`` has one row: ``batches_completed`` of this run, ``failed_batch`` and
    ``message`` (null when all went well), ``stopped_early``.
    """

    plan: IngestResult
    outcomes: DataFrame
    documents: DataFrame
    project_documents: DataFrame | None
    document_tags: DataFrame | None
    progress: DataFrame


def load_files(
    files: DataFrame,
    catalog: DataFrame,
    out: str,
    *,
    base_key: str,
    transfer: Callable[[pd.DataFrame], None] | None = None,
    project_id: int | None = None,
    tag_ids: Sequence[int] = (),
    **options: object,
) -> LoadRun:
    """Load ``files`` batch by batch into tables below ``out``; a second call goes on after the first (runs jobs).

    ``transfer`` gets the files of one batch that are to be loaded (at most 100 rows) in a
    task and raises if it cannot move them.  Batches are moved side by side; published are
    those before the first failing one, with their pins, and nothing of later ones: they
    are moved again by the next call.  Rows are written first and the ledger last, each call
    into a partition of its own (``run=N``, N the number of ledger entries before), which a
    repeated call overwrites: a call that died in between leaves nothing behind that counts.

    ``catalog`` is the table without what lies below ``out``; that is added here.
    """
    spark = files.sparkSession
    ledger, runs = read_table(spark, f"{out}/ledger"), 0
    known = catalog.select("id", "name", "folder_id", "md5")
    if ledger is not None:
        runs = ledger.select("run").distinct().count()
        earlier = spark.read.parquet(f"{out}/documents").where(F.col("run") < runs)
        known = known.unionByName(earlier.select("id", "name", "folder_id", "md5"))
        ledger = ledger.select("batch_key", "payload_hash")
    plan = ingest_files(files, known, base_key=base_key, ledger=ledger, **options)
    outcomes = plan.outcomes
    schema = "batch_no long, message string"

    def move(batch: pd.DataFrame) -> pd.DataFrame:
        message = None
        try:
            transfer(batch.sort_values("ordinal"))
        except Exception as error:  # noqa: BLE001  (whatever goes wrong, the batch has failed)
            message = f"{type(error).__name__}: {error}"
        return pd.DataFrame({"batch_no": [int(batch["batch_no"].iloc[0])], "message": pd.Series([message], dtype=object)})

    failed = spark.createDataFrame([], schema)
    if transfer is not None:
        moved = ["batch_no", "ordinal", "path", "file_name", "folder_id", "document_id", "size", "md5"]
        failed = outcomes.where("uploaded").select(*moved).groupBy("batch_no").applyInPandas(move, schema).where("message is not null")
    failed = materialize(failed, "failed")  # files are moved once
    stopped = steps.stop_at_first_failure(outcomes, failed)
    first = failed.agg(F.min(F.struct("batch_no", "message")).alias("f")).select("f.*").first()
    if first["batch_no"] is None:
        kept, ledger_rows, documents = outcomes, plan.ledger, plan.documents
    else:
        kept = stopped.outcomes
        ledger_rows = steps.batch_payloads(kept).select("batch_key", "payload_hash")
        ids = kept.where("uploaded").select(F.col("document_id").alias("id"))
        documents = plan.documents.join(ids, "id", "left_semi")
    pins = {
        "project_documents": None if project_id is None else steps.pin_project(kept, project_id),
        "document_tags": steps.tag_documents(kept, tag_ids) if tag_ids else None,
    }
    tables = {"documents": documents, "outcomes": kept, **{k: v for k, v in pins.items() if v is not None}}
    if plan.created_folders is not None:
        tables["folders"] = plan.created_folders
    written = {}
    for name, table in tables.items():
        path = f"{out}/{name}/run={runs}"
        table.write.mode("overwrite").parquet(path)
        written[name] = spark.read.schema(table.schema).parquet(path)
    ledger_rows.write.mode("overwrite").parquet(f"{out}/ledger/run={runs}")
    progress = steps.batch_summaries(kept).agg(F.count("*").alias("batches_completed")).select(
        "batches_completed",
        F.lit(first["batch_no"]).cast("long").alias("failed_batch"),
        F.lit(first["message"]).cast("string").alias("message"),
        F.lit(first["batch_no"] is not None).alias("stopped_early"),
    )
    pinned = {name: written.get(name) for name in pins}
    return LoadRun(plan, written["outcomes"], written["documents"], **pinned, progress=progress)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None where there is none yet."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(place) else None
