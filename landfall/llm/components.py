"""Connected components of an edge table, by alternating star contractions that stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace


def connected_components(workspace: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """`edges(a, b)` of longs -> `(node, component)`, the component being its smallest node; nodes without an edge are not listed.

    Large stars hang every larger neighbour of a node on its smallest one, small stars do the same for the
    smaller ones; the number of rounds grows with the logarithm of the longest path. Neighbourhoods are never
    collected: a round is a minimum per node, combined before the shuffle, and a join that may be split where a
    node has very many neighbours. Each round is written, so a lost executor costs one round at most. Loops and
    repeated edges do no harm; no edges give no rows.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before, turn = workspace.table(pairs, f"{name}-0"), None, 0
    while (now := _checksum(pairs)) != before:
        before, turn = now, turn + 1
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        large = workspace.table(large, f"{name}-{turn}-large")
        smallest = large.groupBy("a").agg(F.min("b").alias("low"))
        down = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = down.unionByName(smallest.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        pairs = workspace.table(small, f"{name}-{turn}")
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _checksum(pairs: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first())
