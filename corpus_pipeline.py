"""The corpus pipeline: quality, near-duplicates, repeated passages, contamination, tokens.

Every stage works on all rows that the stage before it kept. A stage's output is written as Parquet and read again as
the next one's input, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricemill.llm import bpe, decontam, quality, simhash, suffixes
from pricemill.llm.common import table
from pricemill.session import run_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of this stage's documents."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that stand earlier already."""
    return suffixes.without_repeats(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    return bpe.digest(bpe.encode(docs))


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("repeated_passages", without_repeats),
    ("decontamination", clean),
    ("tokens", tokens),
]

#: The classifier, XXH64 fingerprints and BPE are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
