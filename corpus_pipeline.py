"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents its predecessor kept, all of them, and is written as Parquet to
the shared folder and read again before the next one. All but the last return the columns
of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.llm import mixing, near_copies, packing, quality, suffix_dedup
from keyrill.llm.queries import TOKENIZER
from keyrill.llm.storage import materialize

# Weights of the sources, None for those of their sizes; tokens of the mix that are packed together.
WEIGHTS: dict[str | None, float] | None = None
MIX_WINDOW = 1 << 21

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality(docs, labels).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word Jaccard 0.8 or more), the one with the smallest doc_id."""
    return near_copies.near_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier; a document of such passages only goes."""
    cut = suffix_dedup.dedup(docs)
    left = (F.col("n_removed") == 0) | (F.translate("text", quality.SPACES, "") != "")
    return cut.filter(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the order in which their sources take turns; the files keep it for ``packed``."""
    return mixing.in_mix_order(docs, weights=WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their place in sequences, which follow the written order: the mix."""
    return packing.pack_as_written(docs, TOKENIZER, MIX_WINDOW)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("source mixing", source_mix),
    ("pattern packing", packed),
]

# Fingerprints, suffix sorting and tokenizing have no SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
