"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, html_text, quality, sanitise, toxicity, word_pieces
from docloom.llm.exact_dedup import exact_duplicates
from docloom.llm.line_dedup import line_classes
from docloom.llm.mixing import mix_sources
from docloom.llm.neighbours import NEIGHBOURS, nearest
from docloom.llm.prefix_trie import prefix_trie
from docloom.llm.simhash import simhash_components
from docloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """n_tokens and the digests of ``ids`` and ``decoded`` per doc_id, with the columns ``more``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def byte_vocabulary() -> byte_bpe.Vocabulary:
    return byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_text.extract(pages, html_text.fit(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(byte_bpe.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), byte_vocabulary()))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = word_pieces.read_pieces(public_tokenizers.path("word_bpe_49k.json"))
    return word_pieces.count_tokens(_table(spark, sf_dir, "documents"), word_pieces.Automaton(pieces))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(_table(spark, sf_dir, "documents")).drop("line")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), NEIGHBOURS, factor=1.0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op11_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(sanitise.private_data(_table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_html_text": op1_html_text,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_mix_sources": op4_mix_sources,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_nearest": op8_nearest,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_private_data": op11_private_data,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": f"""
        WITH normal AS (
          SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
        ), sized AS (
          SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                 sha256(t) AS text_sha256
          FROM normal
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM sized
    """,
    "op8_nearest": """
        WITH usable AS (
          SELECT vec_id, min(embedding::DOUBLE[]) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            AND len([x FOR x IN embedding IF x <> 0]) > 0
          GROUP BY vec_id
        ), scored AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
          FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
}
