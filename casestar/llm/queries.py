"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.llm import (collocations, cotraining, decontamination, html, mixing, quality, rlz,
                          sharding, simhash, suffixes, tokencount, turntrie, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(_table(spark, sf_dir, "pages"))


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.without_copied(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(turntrie.rebuilt(_table(spark, sf_dir, "conversations")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
