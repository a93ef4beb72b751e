"""Thin registered queries over the operators of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.llm import (chat, decontaminate, extract, language, lines, manifest, neardup, packing, private, quality, resample,
                          toxicity, urls)
from rsvpflow.llm.batches import crc_mod
from rsvpflow.llm.oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs, crc_mod(F.col("doc_id"), 4) != 2)
    return language.identify(docs, model).withColumn("held_out", crc_mod(F.col("doc_id"), 4) == 2)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, model).withColumn("held_out", crc_mod(F.col("doc_id"), 5) == 0)


def op4_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.personal_data(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, sf_dir, "documents"), line_words=10)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents")).drop("text")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = chat.with_probe(spark, _table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_chat(convs, tokenizer_path("byte_bpe_50k.json")))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=4)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    man = manifest.document_manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return man.proofs().select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: The rules of op13: (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "verdict string, host string, path string"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {"op1_language": op1_language, "op2_extract": op2_extract, "op3_toxicity": op3_toxicity, "op4_private": op4_private,
           "op5_decontaminate": op5_decontaminate, "op6_lines": op6_lines, "op7_packing": op7_packing, "op8_quality": op8_quality,
           "op9_chat": op9_chat, "op10_neardup": op10_neardup, "op11_manifest": op11_manifest,
           "op12_resample": op12_resample, "op13_urls": op13_urls}
