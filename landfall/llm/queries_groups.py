"""The registered queries of the prefix trie and of clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import centroids, prefix_trie
from landfall.llm.frames import prepare, read_table


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return prefix_trie.conversation_trie(read_table(prepare(spark), sf_dir, "conversations")).select(*columns)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read_table(prepare(spark), sf_dir, "embeddings")).drop("n_verified")


def registered() -> dict:
    return {"op12_prefix_trie": op12_prefix_trie, "op13_centroids": op13_centroids}
