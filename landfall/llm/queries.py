"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import containment, minhash_dedup, mixing, oracle, oracle_groups, quality_rules, queries_groups, queries_text, sharding
from landfall.llm.frames import prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, "documents")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.quality_rules(_documents(spark, sf_dir)).select(*columns)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return sharding.sharded(_documents(spark, sf_dir)).select(*columns)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_documents(spark, sf_dir), shingle=3, percent=85).drop("text_hash")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_documents(spark, sf_dir)).per_document()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = containment.contained(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_shingles", "n_shared", "containment")


def registered() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op3_sharding": op3_sharding,
        "op7_minhash": op7_minhash,
        "op9_mixing": op9_mixing,
        "op10_decontamination": op10_decontamination,
    } | queries_text.registered() | queries_groups.registered()


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | oracle_groups.oracle_sql()
