"""The registered queries of the subpackage, and the SQL text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.llm import alignment, bpe, fingerprints, html_text, minhash, mixing, nearest, quality, sharding, simhash, substrings, token_counts, vector_codes
from hemicycle.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated windows of 35 words removed from every document."""
    cut = substrings.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc.doc_id", "n_words", "n_removed", F.col("sha256").alias("kept_sha256"))


@query
def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of the documents."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query
def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of equal row counts along a Hilbert curve."""
    return sharding.shard_documents(table(spark, folder, "documents"))


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The words that a mix of the sources by weight takes of every document."""
    mixed = mixing.mixed_rows(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL["op9_mixing"] = mixing.MIXED_SQL


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op7_bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.encoded(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.scored(table(spark, folder, "documents"), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op4_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors of every fiftieth one."""
    return nearest.top_scores(table(spark, folder, "embeddings"))


@query
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(table(spark, folder, "pages"))


SQL["op4_top_scores"] = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


@query
def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and the components of those at most three bits apart."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two vocabularies aligned in every document, with the corpus-wide counts of their links."""
    return alignment.aligned(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of every vector by four codebooks of 256 entries, and their errors."""
    return vector_codes.compressed(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))
