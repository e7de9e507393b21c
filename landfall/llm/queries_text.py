"""The registered queries of the operators that read texts one by one, and of repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import chat_format, language_id, quality_classifier, substring_dedup, token_counts, toxicity
from landfall.llm.frames import prepare, read_table

# A conversation that holds the template's own strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"
CONTROL_ID = -7


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_classifier.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(prepare(spark), sf_dir, "documents")).drop("text_hash")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(read_table(prepare(spark), sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as bigint) as conv_id", "cast(turn as bigint) as turn", "role", "text")
    control = [(CONTROL_ID, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    return rows.unionByName(spark.createDataFrame(control, rows.schema))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return chat_format.digests(chat_format.windows(conversations(spark, sf_dir)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(prepare(spark), sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def registered() -> dict:
    return {
        "op2_quality_classifier": op2_quality_classifier,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_language_id": op5_language_id,
        "op6_chat_format": op6_chat_format,
        "op8_token_counts": op8_token_counts,
        "op11_toxicity": op11_toxicity,
    }
