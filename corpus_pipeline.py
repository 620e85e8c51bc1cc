"""A corpus pipeline over ``documents``: quality, near copies, repeated passages, mix, tokens.

Each stage takes what the one before kept, with all its columns, and is written before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.llm import bpe, minhash, mixing, quality, queries, substrings
from hemicycle.llm.common import table
from hemicycle.session import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts; null texts count as empty."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    return minhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur again; others are left as they are."""
    cut = substrings.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    kept = {c: F.col("doc").getField(c) for c in docs.columns}
    kept["text"] = F.when(changed, F.col("kept")).otherwise(kept["text"])
    if "n_chars" in kept:
        kind = docs.schema["n_chars"].dataType
        kept["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(kept["n_chars"])
    return cut.select(*[value.alias(c) for c, value in kept.items()])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def encoded_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    return bpe.encoded(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("near-dedup", without_near_copies),
    ("substring dedup", without_repeats),
    ("mixing", mixed_sources),
    ("encoding", encoded_texts),
]

#: The classifier, the shingle links and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return STAGES[-1][1](spark, docs, sf_dir)
