"""Corpus pipeline: ``documents`` through the operators, one stage after another.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame. ``run`` writes every stage's result to the shared
folder and reads it back, so a lost executor never repeats a finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import bpe, exact_dedup, mixing, quality, simhash
from riverbed.llm.base import prepare, read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    prepare(spark)
    return simhash.drop_near_copies(docs, shingle=3, max_bits=3)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document taken twice is two rows."""
    prepare(spark)
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the digests of the ids and of the text decoded from them."""
    prepare(spark)
    return bpe.round_trip(docs, with_ids=True)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact), ("near dedup", near_copies),
          ("mixing", mixture), ("tokens", tokens)]

#: SQL cannot express the divergence, fingerprint and token stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
