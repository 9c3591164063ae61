"""The corpus pipeline: documents to packed training sequences.

Quality rules, toxicity, near duplicates, mixing of sources, packing.  Each
stage reads what the one before it kept, from Parquet in the shared folder
that ``spark.checkpoint.dir`` names.  All stages but the last return the
columns of ``documents``; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import jaccard, mixing, packing, quality, toxicity
from starmart.llm.common import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject."""
    return quality.filter_documents(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic; the model learns from the labelled documents among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.filter_documents(docs, toxicity.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return jaccard.filter_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents so that sources meet their weights: a row for each time one is taken."""
    return mixing.filter_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mix into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("n-gram jaccard join", near_duplicates),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Token ids and learned scores can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
