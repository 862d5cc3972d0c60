"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and returns the
columns of documents; the last one returns the packed pieces. Between stages the table is written
as Parquet below ``spark.checkpoint.dir``, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from herdcast.llm import importance, jaccard_join, language_id, mixing, packing
from herdcast.llm.common import materialise, table
from herdcast.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose language is too uncertain."""
    return language_id.accepted(docs, language_id.fit(docs, held_out=None))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that importance resampling against good labelled text does not sample."""
    return importance.resample(docs, importance.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that shares 80 % of its five-word shingles."""
    return jaccard_join.deduplicate(docs, jaccard_join.Join(width=5, percent=80))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poisson replication to the square root of each source's share, in global random order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [("language_id", language), ("quality_classifier", quality), ("near_duplicates", near_duplicates),
          ("mixing", mix), ("packing", pack)]

#: SQL cannot express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
