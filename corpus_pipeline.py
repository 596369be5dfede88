"""The training-corpus pipeline: five stages from raw documents to shards.

Each stage takes what its predecessor kept, written as Parquet and read again.
``run`` writes the hand-overs to the shared folder that the cluster names.
Counted as part of ``strata.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, mixing, quality_rules, simhash, token_shards
from strata.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the combined quality rules keep."""
    return quality_rules.keep_good(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight calls for."""
    return mixing.mixed_documents(docs)


def shards_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; returns their index."""
    return token_shards.token_shards(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_shards", shards_stage),
]

#: The first stage is an expectation-maximisation and the second a transitive
#: closure over hash bits; SQL has neither. ``tests/llm`` holds each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
