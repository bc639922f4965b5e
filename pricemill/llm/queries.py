"""The queries over the supplied tables that apply each corpus operator with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemill.llm import (
    blockmax,
    bpe,
    debruijn,
    decontam,
    filteraudit,
    hardneg,
    htmltext,
    langid,
    quality,
    sharding,
    simhash,
    suffixes,
    templates,
)
from pricemill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.digest(debruijn.repeated_words(table(spark, sf_dir, "documents")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.repeated_bytes(table(spark, sf_dir, "documents")))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockmax.top_k(table(spark, sf_dir, "embeddings"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.judge(table(spark, sf_dir, "pages"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_substrings": op4_substrings,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_suffixes": op7_suffixes,
    "op8_topk": op8_topk,
    "op9_shards": op9_shards,
    "op10_html": op10_html,
    "op11_urls": op11_urls,
    "op12_negatives": op12_negatives,
    "op13_audit": op13_audit,
    "pipeline": pipeline,
}
