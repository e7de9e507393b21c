"""Exact links between nodes that share a band of their signatures, without listing the pairs of a group.

A node is one distinct shingle set. Nodes that share a bucket are joined to the bucket's smallest node only (a
star), and the stars' components bound where links can be. Links are then decided on full sets:

1. every node of a component against its smallest node: one comparison a node;
2. where some node is not linked to it, the remaining nodes against all of the component, in blocks: a task indexes
   a few hundred sets, fewer of long ones, and streams the others past them. It hands on only links that join what it has not joined
   yet, so what is written stays in proportion to the nodes, never to the pairs.

So every pair that shares a bucket, directly or through others, is linked, or implied by links, or compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.components import connected_components
from landfall.llm.frames import Workspace, small_or_plain

# Sets that a task indexes at once, and sets that it streams past them.
BLOCK, SLICE = 256, 4096
# Shingles, of 8 bytes, that a task indexes at once (about, sets being dealt by hash), that it streams past them at once, and equal pairs of
# both that it lists at once. Whatever sets are long or alike, a task holds so much; a single longer set is taken whole.
BLOCK_SHINGLES, PART_SHINGLES, PAIRS = 1 << 20, 1 << 18, 1 << 19
LINK = "a long, b long"


def enough(common, left, right, percent: int):
    """100 * intersection >= percent * union."""
    return 100 * common >= percent * (left + right - common)


def star_edges(workspace: Workspace, bands: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """`(node, bands array<long>)` -> `(a, b)`: each node of a bucket to the smallest node of it, `heads(bucket, head)` where they are known."""
    rows = bands.select("node", F.explode("bands").alias("bucket"))
    if heads is None:
        heads = rows.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last"))
        heads = workspace.table(heads.filter("head <> last").select("bucket", "head"), "heads")
    joined = rows.join(small_or_plain(heads), "bucket").filter("node <> head")
    return workspace.table(joined.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "stars")


def candidate_groups(workspace: Workspace, bands: DataFrame) -> DataFrame:
    """`(node, component)` of the nodes that share a bucket with another one, through any number of steps."""
    return workspace.table(connected_components(workspace, star_edges(workspace, bands), "candidates"), "groups")


def links(workspace: Workspace, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`groups(node, component)`, `sets(node, shingles binary)` -> `(a, b)` links with Jaccard >= percent / 100.

    The links have the same components as all links between the nodes of a group.
    """
    members = workspace.table(sets.join(small_or_plain(groups), "node"), "members")
    centres = members.filter("node = component").select("component", F.col("shingles").alias("centre"))
    starred = members.filter("node <> component").join(centres, "component")
    starred = workspace.table(starred.mapInArrow(_against_centre(percent), "component long, node long, linked boolean, size long"), "starred")
    first = starred.filter("linked").select(F.col("component").alias("a"), F.col("node").alias("b"))
    rest_shingles = F.sum(F.when(~F.col("linked"), F.col("size")))
    sizes = starred.groupBy("component").agg(F.count("*").alias("nodes"), F.count_if(~F.col("linked")).alias("rest"), rest_shingles.alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("rest") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    sizes = sizes.filter("rest > 0 and nodes > 1").select("component", blocks.alias("blocks"), F.ceil(F.col("nodes") / SLICE).alias("slices"))
    waiting = workspace.table(starred.drop("size").join(sizes, "component"), "waiting")
    open_rows = workspace.table(members.select("node", "shingles").join(small_or_plain(waiting), "node"), "open")
    rest = _in_blocks(workspace, open_rows, percent, "rest")
    return workspace.table(first.unionByName(rest).distinct(), "links")


def links_of_stars(workspace: Workspace, edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`star_edges` and `sets(node, shingles binary)`, each node once -> `(a, b)` links with Jaccard >= percent / 100, with the same
    components as all links between nodes that share a band.

    Where `links` compares inside the component of many stars, this compares inside each star: a node with the head it shares a band with,
    and, if it is not linked to it, with the nodes of that head that can reach the threshold. So stars that are chained by chance cost no more
    than each alone. Of two sets at the threshold, each has one of its first shingles, as many as may be missing in the other and one
    more, in common with the other's, in whatever order all are taken; those that the head lacks come first, so nodes that share only what
    the head has are not compared.
    """
    heads = edges.select(F.col("a").alias("component")).distinct()
    groups = edges.select(F.col("a").alias("component"), F.col("b").alias("node"))
    members = workspace.table(groups.join(sets, "node").select("component", "node", "shingles"), "star-members")
    centres = heads.join(sets, heads["component"] == sets["node"]).select("component", F.col("shingles").alias("centre"))
    starred = members.join(centres, "component")
    starred = workspace.table(starred.mapInArrow(_with_prefix(percent), "component long, node long, linked boolean, prefix array<long>"), "star-linked")
    first = starred.filter("linked").select(F.col("component").alias("a"), F.col("node").alias("b"))
    tokens = starred.select("component", "node", "linked", F.explode("prefix").alias("token"))
    sizes = tokens.groupBy("component", "token").agg(F.count("*").alias("nodes"), F.count_if(~F.col("linked")).alias("rest")).filter("rest > 0 and nodes > 1")
    sizes = sizes.select("component", "token", F.ceil(F.col("rest") / BLOCK).alias("blocks"), F.ceil(F.col("nodes") / SLICE).alias("slices"))
    waiting = workspace.table(tokens.join(sizes, ["component", "token"]), "star-waiting")
    open_rows = workspace.table(members.join(waiting, ["component", "node"]), "star-open")
    return workspace.table(first.unionByName(_in_blocks(workspace, open_rows, percent, "star-rest")).distinct(), "star-links")


def _in_blocks(workspace: Workspace, open_rows: DataFrame, percent: int, name: str) -> DataFrame:
    """Links of `open_rows(component, node, linked, shingles, blocks, slices)`: the nodes that are not linked to their centre, in blocks, with all."""
    own = F.xxhash64("node")
    if "token" not in open_rows.columns:
        open_rows = open_rows.withColumn("token", F.lit(0).cast("long"))
    indexed = open_rows.filter("not linked").select(
        "component", "token", F.pmod(own, "blocks").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        F.lit(False).alias("streamed"), "node", "linked", "shingles",
    )
    streamed = open_rows.select(
        "component", "token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(own, "slices").alias("slice"),
        F.lit(True).alias("streamed"), "node", "linked", "shingles",
    )
    key = ["component", "token", "block", "slice"]
    blocks = indexed.unionByName(streamed).repartition(*key).sortWithinPartitions(*key, "streamed")
    return workspace.table(blocks.mapInArrow(_within_blocks(percent), LINK), name)


def one_of_each(workspace: Workspace, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the wanted nodes, each once. They are written where they were made; only those of nodes that came more
    than once are grouped."""
    found = workspace.table(sets.join(small_or_plain(wanted), "node", "left_semi"), "found-sets")
    often = workspace.table(found.groupBy("node").count().filter("count > 1").select("node"), "repeated-sets")
    once = found.join(small_or_plain(often), "node", "left_anti")
    repeated = found.join(small_or_plain(often), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return once.unionByName(repeated)


def _array(shingles: bytes) -> np.ndarray:
    return np.frombuffer(shingles, np.uint64)


def _against_centre(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, sizes, seen, inside = [], [], None, None
            for own, other in zip(batch.column("shingles").to_pylist(), batch.column("centre").to_pylist()):
                if other is not seen and other != seen:
                    seen, inside = other, _array(other)
                mine = _array(own)
                sizes.append(len(mine))
                common = len(np.intersect1d(mine, inside, assume_unique=True))
                linked.append(enough(common, len(mine), len(inside), percent))
            columns = [batch.column("component"), batch.column("node"), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["component", "node", "linked", "size"])

    return run


def _with_prefix(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, prefixes, seen, inside = [], [], None, None
            for own, other in zip(batch.column("shingles").to_pylist(), batch.column("centre").to_pylist()):
                if other is not seen and other != seen:
                    seen, inside = other, _array(other)
                mine = _array(own)
                shared = np.isin(mine, inside, assume_unique=True)
                linked.append(enough(int(shared.sum()), len(mine), len(inside), percent))
                needed = len(mine) + 1 - -(-percent * len(mine) // 100)
                prefixes.append(np.concatenate((mine[~shared], mine[shared]))[:needed].view(np.int64))
            ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in prefixes]))).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("component"), batch.column("node"), pa.array(linked, pa.bool_()), lists], ["component", "node", "linked", "prefix"])

    return run


class _Block:
    """An index of some sets, against which others are compared."""

    def __init__(self, percent: int) -> None:
        self.percent, self.nodes, self.sets, self.index, self.parent = percent, [], [], None, {}

    def add(self, node: int, own: np.ndarray) -> None:
        self.nodes.append(node)
        self.sets.append(own)

    def _root(self, x: int) -> int:
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[up] = self.parent.setdefault(up, up)
            x = self.parent[x]
        return x

    def compare(self, rows: list[tuple[int, int | None, np.ndarray]]) -> list[tuple[int, int]]:
        """Links of streamed sets that this block does not imply yet. A set linked to the centre, which comes with it, belongs to it."""
        if not self.nodes or not rows:
            return []
        if self.index is None:
            self.sizes = np.array([len(x) for x in self.sets])
            owner = np.repeat(np.arange(len(self.sets)), self.sizes)
            values = np.concatenate(self.sets)
            order = np.argsort(values, kind="stable")
            self.values, self.owner, self.index = values[order], owner[order], True
            self.sets = []
        found = []
        common = self._common([own for _, _, own in rows])
        sizes = np.array([len(own) for _, _, own in rows])
        for node, centre, _ in rows:
            if centre is not None and self._root(node) != self._root(centre):
                self.parent[self._root(node)] = self._root(centre)
        for row, i in zip(*(x.tolist() for x in np.nonzero(enough(common, self.sizes, sizes[:, None], self.percent)))):
            node, other = rows[row][0], self.nodes[i]
            if other != node and self._root(other) != self._root(node):
                self.parent[self._root(other)] = self._root(node)
                found.append((node, other))
        return found

    def _common(self, sets: list[np.ndarray]) -> np.ndarray:
        """How many shingles each streamed set has in common with each indexed one."""
        many = len(self.nodes)
        every = np.concatenate(sets)
        low = np.searchsorted(self.values, every, "left")
        met = np.flatnonzero(self.values[np.minimum(low, len(self.values) - 1)] == every)
        low, lengths = low[met], np.searchsorted(self.values, every[met], "right") - low[met]
        streamed = np.repeat(np.arange(len(sets)), [len(own) for own in sets])[met]
        common, ends, at = np.zeros(len(sets) * many, np.int64), np.cumsum(lengths), 0
        while at < len(met):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + PAIRS, "right")))
            held = lengths[at:upto]
            place = np.repeat(low[at:upto] - (np.cumsum(held) - held), held) + np.arange(held.sum())
            common += np.bincount(np.repeat(streamed[at:upto], held) * many + self.owner[place], minlength=len(common))
            at = upto
        return common.reshape(len(sets), many)


def _within_blocks(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for batch in batches:
            found, held = [], 0
            waiting: list[tuple[int, int | None, np.ndarray]] = []
            columns = (batch.column(c).to_pylist() for c in ("component", "token", "block", "slice", "streamed", "node", "linked", "shingles"))
            for component, token, number, part, streamed, node, linked, shingles in zip(*columns):
                if (component, token, number, part) != now or len(waiting) >= BLOCK or held >= PART_SHINGLES:
                    if waiting:
                        found += block.compare(waiting)
                    waiting, held = [], 0
                if (component, token, number, part) != now:
                    now, block = (component, token, number, part), _Block(percent)
                own = _array(shingles)
                if streamed:
                    waiting.append((node, component if linked else None, own))
                    held += len(own)
                else:
                    block.add(node, own)
            if waiting:
                found += block.compare(waiting)
            a, b = ([x[i] for x in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run
