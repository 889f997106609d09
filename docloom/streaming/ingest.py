"""Continuous ingest of arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.ingest import MAX_BATCH_FILES
from docloom.plans.ingest import ingest_files, read_table
from docloom.session import materialize
from docloom.sources.files import hashed, relative_path


def ingest_stream(
    spark: SparkSession,
    inbox: str,
    catalog: DataFrame,
    out: str,
    *,
    base_key: str,
    flatten: bool = True,
    folder_id: int | None = None,
    on_duplicate: str = "allow",
    max_size: int | None = None,
    batch_size: int = MAX_BATCH_FILES,
    on_batch: Callable[[DataFrame], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Load files as they arrive below ``inbox`` into tables below ``out``.

    Each micro-batch goes through the batch steps against ``catalog`` and what
    earlier micro-batches loaded, and overwrites its own partition of
    ``out/documents``, ``out/outcomes`` and ``out/_known``: a repeated micro-batch leaves no
    second copy.  Files are hashed in tasks by chunks, once.  Of the history it reads
    ``_known`` (id, name, folder, md5 of what was loaded) and one row per micro-batch for the
    ids, and works only on rows that share a name or content with the arriving files.
    ``on_batch`` gets the per-batch counts.

    Names never stop the stream: of files that arrive for the same place in one
    micro-batch the first by path is loaded, the others are rejected outcomes that carry its id,
    like those that meet a name from before.
    """
    arriving = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(inbox)
    )
    # Without the contents: they are read where they are hashed.
    files = arriving.select("path", F.col("length").alias("size"))

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        listed = materialize(batch, "listed")
        arrived = materialize(hashed(listed).withColumn("rel_path", relative_path(F.col("path"), inbox)), "arrived")
        columns = ["id", "name", "folder_id", "md5"]
        known = catalog.select(columns)
        highest = 0
        done, marks = read_table(session, f"{out}/_known"), read_table(session, f"{out}/_highest")
        if done is not None:
            known = known.unionByName(done.where(F.col("epoch") < number).select(columns))
        if marks is not None:
            # Ids of blocked files have been reported; they are not given again.
            highest = marks.where(F.col("epoch") < number).agg(F.max("highest")).first()[0] or 0
        if not highest:
            highest = catalog.agg(F.max("id")).first()[0] or 0
        # Only what shares a content or a name with this micro-batch takes part.
        name = F.substring_index("path", "/", -1) if flatten else F.col("rel_path")
        same = [
            known.join(arrived.select("md5").distinct(), "md5", "left_semi"),
            known.join(arrived.select(name.alias("name")).distinct(), "name", "left_semi"),
        ]
        concerned = same[0].select(columns).unionByName(same[1].select(columns)).distinct()
        result = ingest_files(
            arrived.withColumn("folder_id", F.lit(folder_id).cast("long")),
            concerned,
            base_key=f"{base_key}-{number}",
            flatten=flatten,
            path_col="path" if flatten else "rel_path",
            on_duplicate=on_duplicate,
            max_size=max_size,
            batch_size=batch_size,
            check_names=False,
            first_id=highest + 1,
        )
        tables = {"outcomes": result.outcomes, "documents": result.documents}
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{out}/{name}/epoch={number}")
        written = session.read.schema(result.documents.schema).parquet(f"{out}/documents/epoch={number}")
        written.select(columns).write.mode("overwrite").parquet(f"{out}/_known/epoch={number}")
        last = result.outcomes.agg(F.greatest(F.max("document_id"), F.lit(highest)).cast("long").alias("highest"))
        last.write.mode("overwrite").parquet(f"{out}/_highest/epoch={number}")
        if on_batch is not None:
            on_batch(result.batches)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", f"{out}/_progress")
    return writer.trigger(**(trigger or {"availableNow": True})).start()

