"""From documents to training shards: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage keeps all columns of its input, whatever their names. Null, empty and word-less texts fail the quality rules; rows that repeat a
doc_id and text are one document for the filters; no rows give no rows. Only the last stage adds columns.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from landfall.llm import containment, minhash_dedup, mixing, quality_rules, sharding  # noqa: E402
from landfall.llm.frames import Workspace, prepare, read_table  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality_rules.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return minhash_dedup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return containment.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources uses them, in no case more than twice, one output shard of the mix after the other
    and each in its shuffled order."""
    prepare(spark)
    return mixing.Mix(docs).documents()


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it."""
    prepare(spark)
    return sharding.sharded(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

# MinHash candidates and hypergeometric draws have no SQL counterpart; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.table(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
