"""The registered queries of this subpackage, each an operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, fingerprints, language, line_dedup, near_dup, pieces, prefix_trie, repeats, sharding, simhash, structure_repair, tokens, warc
from millrace.llm.queries_sql import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digest(documents(spark, sf_dir))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_edits(documents(spark, sf_dir))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_with_limit(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(documents(spark, sf_dir))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(documents(spark, sf_dir))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Query]:
    every = (
        op1_repeats,
        op2_fingerprints,
        op3_near_duplicates,
        op4_token_counts,
        op5_pieces,
        op6_decontamination,
        op7_line_dedup,
        op8_warc,
        op9_language,
        op10_shards,
        op11_simhash,
        op12_prefix_trie,
        op13_structure_repair,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
