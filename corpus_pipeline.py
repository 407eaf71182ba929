"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, source
mixing, and byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  Stages define their results for nulls, empty and
long texts, ties, repeated rows and empty tables as the operators they call do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import bpe, exact_dedup, mixing, quality, simhash
from gristmill.llm.common import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.judge(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, lang, n_tokens and the ids."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, vocabulary, keep=["doc_id", "lang", "source"], with_ends=False).selectExpr("doc_id", "lang", "source", "cast(size(ids) as bigint) as n_tokens", "ids")


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("simhash_near_dedup", near), ("source_mixing", mix), ("byte_bpe", encode)]

#: The result has SimHash components, a balanced sample and BPE ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
