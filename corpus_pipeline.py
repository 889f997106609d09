"""The corpus pipeline: documents without toxic rows and copies, mixed by source and encoded.

Stages go by rows and not by ids, so null and repeated ids are handled like others: the
toxicity stage drops the rows whose text is predicted toxic (null and empty texts have a
score too), the copy stages leave one row of each class (fully repeated rows are copies;
of rows that differ in other columns only, the least as JSON).  Null texts count as empty.
An empty table gives empty results.  All but the last stage return the columns of their input,
whatever those are; the last one those it names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, toxicity
from docloom.llm.exact_dedup import without_exact_duplicates
from docloom.llm.mixing import mix_sources, mixed
from docloom.llm.queries import byte_vocabulary, digests
from docloom.llm.simhash import without_near_duplicates
from docloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels of ``docs``, does not reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts, the one of the largest id."""
    return without_exact_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (three-word shingles, at most 3 of 64 bits), the one of the smallest id."""
    return without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources alternate by the square root of their sizes."""
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document doc_id, source, mix_position, ids, n_tokens and the digests of ids and decoded bytes.

    ``mix_position`` is the document's place in the mixture: the order of the files that the
    stage before wrote, as a column (it follows from the same rows).  Rows that share id and
    source have the first of their places.
    """
    order = mix_sources(docs).groupBy("doc_id", "source").agg(F.min("mix_position").alias("mix_position"))
    order = order.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "mix_position")
    same = docs["doc_id"].eqNullSafe(order["__id"]) & docs["source"].eqNullSafe(order["__source"])
    placed = docs.join(order, same, "left").select("doc_id", "source", "mix_position", "text")
    return digests(byte_bpe.round_trip(placed, byte_vocabulary()), "source", "mix_position", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_exact_copies),
    ("simhash_dedup", remove_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]

#: SQL can express neither the first nor the last stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
