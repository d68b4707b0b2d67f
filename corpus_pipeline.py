"""A corpus pipeline of four stages, each an operator of cohesion.llm: quality, exact copies, near copies, packing.

Every stage works on all that the one before kept; its rows are written as Parquet
in the shared folder and read again. The first three return the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohesion.llm import ngram_join, packing, quality_crf, stream_dedup
from cohesion.llm.common import cut, table
from cohesion.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the line field does not reject."""
    return quality_crf.keep_good(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return stream_dedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack)]

#: The classifier is learned and ids come from a tokenizer, so SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
