"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.llm import chat, langid, mixing, packing, quality, repair, runs, sharding, simhash, spotsigs, suffix_dedup, token_files, warc
from keyrill.llm.oracle import ORACLE  # noqa: F401

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_read(spark, folder, "documents"), TOKENIZER, with_ids=False)


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_digest(_read(spark, folder, "documents"))


def op3_pfair_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digest(_read(spark, folder, "documents"))


def op4_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.spotsigs_digest(_read(spark, folder, "documents"))


def op5_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    return warc.warc_digest(_read(spark, folder, "pages"))


def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_digest(_read(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_digest(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_digest(chat.with_probe(_read(spark, folder, "conversations")))


def op9_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digest(_read(spark, folder, "documents"))


def op10_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_digest(_read(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = _read(spark, folder, "documents")
    return runs.run_digest(documents.withColumn("text", runs.planted(F.col("doc_id"), F.col("text"))))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.audit(repair.damaged(_read(spark, folder, "conversations")), "alive")


def op13_elias_fano_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_digest(_read(spark, folder, "documents"), WORD_TOKENIZER)


QUERIES = {f.__name__: f for f in (
    op1_pattern_packing, op2_suffix_dedup, op3_pfair_mixing, op4_spotsigs, op5_warc_bundles, op6_simhash_dedup,
    op7_quality_rules, op8_chat_format, op9_extendible_sharding, op10_kernel_language, op11_periodic_runs, op12_conversation_repair,
    op13_elias_fano_ids,
)}
