"""The corpus pipeline: rules, near-duplicates, benchmark leaks, mixing, sharding.

Each stage reads what the one before it wrote and returns the columns of ``documents``; the last
returns the shards. A stage's decisions take effect on the rows that the next one gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casestar.llm import decontamination, mixing, quality, sharding, simhash
from casestar.llm.common import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules reject go."""
    return quality.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, stay or go as the mix takes them."""
    return mixing.mixed_documents(docs)


def sharding_by_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets a shard and a slot in it, and carries its text there."""
    return sharding.balanced_shards(docs, keep=("text",))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding_by_bytes),
]

# Fingerprints over shingle hashes and edit matching are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
