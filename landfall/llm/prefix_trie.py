"""The trie of shared conversation prefixes, by truncation peeling over sorted conversations.

A turn is 24 bytes, the MD5 of its role and text and the text's length; a conversation is the string of its turns. Sorted by
that string, conversations that share a prefix stand together, shorter ones first, so a task meets the trie in order and holds
one path of it. Between two conversations it peels: from the deepest turn of the one before it strips turn after turn until
what remains is a prefix of the next one. Each node stripped is complete, is handed on with what was gathered below it, and is
merged into the node that survives; a conversation that ends there joins it. Nodes are found and summed up in this one pass,
however deep the trie is.

Conversations are spread over tasks by ranges of that order, so a prefix or a group of copies that holds a third of them is the work of many
tasks. The nodes above a task's first and last conversation may go on in other tasks: they are handed on as parts, at most two
paths for each task, and one more peel puts them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace

TURN = 24  # bytes of a turn in a path
HEADS, FAMILY = 9, 5  # of the rebuilt conversations
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Decimal ids of conversations that end at one node are handed on in blocks of about this size, if they are many.
BLOCK = 1 << 20
ROWS = 20_000
_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = [
    ("whole", pa.bool_(), "boolean"), ("node", pa.binary(), "binary"), ("parent", pa.binary(), "binary"), ("depth", pa.int64(), "long"),
    ("n_bytes", pa.int64(), "long"), ("conv_id", pa.int64(), "long"), ("n_convs", pa.int64(), "long"), ("n_children", pa.int64(), "long"),
    ("n_leaves", pa.int64(), "long"), ("saved_tokens", pa.int64(), "long"), ("ends_sha256", pa.string(), "string"),
    ("block_start", pa.int64(), "long"), ("block", pa.binary(), "binary"),
]
NODE_ROW = ", ".join(f"{name} {kind}" for name, _, kind in _NODE)


def _batch(rows: list[tuple], fields=_NODE) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind, _) in enumerate(fields)], [name for name, _, _ in fields])


def paths(conversations: DataFrame) -> DataFrame:
    """`conversations(conv_id, turn, role, text)` -> conv_id, path: its turns in order, 24 bytes each.

    Null roles and texts are empty. Null turns come first; turns of equal number stand by their digest. Rows
    without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn.alias("hex"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "hex")))
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t.hex), "")).alias("path"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Of the conversations c: the first h turns of conversation c - c % 5 (as many as it has, none if there is none), then
    c's own after its first h, where h is the crc32 of c in decimal modulo 9. The remainder has the sign of c, as in SQL."""
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS * TURN).cast("int")
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head"), F.substring("path", 1, (HEADS - 1) * TURN).alias("start"))
    joined = own.select("conv_id", "path", head.alias("head"), cut.alias("cut")).join(heads, "head", "left")
    start = F.substring(F.coalesce("start", F.lit(b"")), F.lit(1), F.col("cut"))
    rest = F.substring(F.col("path"), F.col("cut") + 1, F.octet_length("path"))
    return joined.select("conv_id", F.concat(start, rest).alias("path"))


class _Node:
    __slots__ = ("key", "n_bytes", "n", "low", "children", "leaves", "saved", "ends", "open")

    def __init__(self, key: bytes, n_bytes: int, is_open: bool) -> None:
        self.key, self.n_bytes, self.open = key, n_bytes, is_open
        self.n, self.low, self.children, self.leaves, self.saved, self.ends = 0, None, 0, 0, 0, ""

    def merge(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)


class _Peel:
    """The path from the root to the current conversation, and the rows that are done."""

    def __init__(self) -> None:
        self.stack: list[_Node] = []
        self.path = b""
        self.rows: list[tuple] = []
        self.ids: list[bytes] = []  # of the conversations that end at the top of the stack, not handed on yet
        self.start, self.held, self.blocks, self.first = None, 0, False, True

    def add(self, conv_id: int, path: bytes) -> None:
        if not self.stack:
            self.stack.append(_Node(ROOT, 0, True))
            self._descend(path, True)
        elif path != self.path:
            self._close_ends(self.first)
            self.first = False
            shared = _shared(self.path, path) // TURN
            while len(self.stack) > shared + 1:
                self._strip()
            self._descend(path, False)
        self.path = path
        self.stack[-1].merge(1, conv_id)
        text = b"%d" % conv_id
        if self.start is None:
            self.start = conv_id
        self.ids.append(text)
        self.held += len(text) + 1
        if self.held > BLOCK:
            self._block()

    def finish(self) -> None:
        if self.stack:
            self._close_ends(True)
            for node in self.stack:
                node.open = True
            while self.stack:
                self._strip()

    def _descend(self, path: bytes, is_open: bool) -> None:
        for at in range((len(self.stack) - 1) * TURN, len(path), TURN):
            turn = path[at : at + TURN]
            key = hashlib.md5(self.stack[-1].key + turn).digest()
            self.stack.append(_Node(key, int.from_bytes(turn[16:], "big"), is_open))

    def _block(self) -> None:
        nothing = [None] * 9
        self.rows.append((None, self.stack[-1].key, *nothing, self.start, b",".join(self.ids)))
        self.ids, self.start, self.held, self.blocks = [], None, 0, True

    def _close_ends(self, may_go_on: bool) -> None:
        """A digest, unless the run of equal conversations may go on in another task or is handed on in blocks."""
        if self.ids and (self.blocks or may_go_on):
            self._block()
        self.stack[-1].ends = None if self.blocks else hashlib.sha256(b",".join(self.ids)).hexdigest()
        self.ids, self.start, self.held, self.blocks = [], None, 0, False

    def _strip(self) -> None:
        node = self.stack.pop()
        depth, above = len(self.stack), self.stack[-1] if self.stack else None
        if node.open:
            sums = (node.children, node.leaves, node.saved)
        else:
            sums = (node.children, node.leaves if node.children else 1, node.saved + (node.n - 1) * node.n_bytes)
        # Parts leave it open whether other tasks have conversations that end here.
        ends = node.ends if node.ends != "" else None if node.open else NO_ENDS
        self.rows.append((not node.open, node.key, above.key if above else None, depth, node.n_bytes, node.low, node.n, *sums, ends, None, None))
        if above is not None:
            above.merge(node.n, node.low)
            if not node.open:
                above.children, above.leaves, above.saved = above.children + 1, above.leaves + sums[1], above.saved + sums[2]


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    peel = _Peel()
    for batch in batches:
        for conv_id, path in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist()):
            peel.add(conv_id, path)
            if len(peel.rows) >= ROWS:
                yield _batch(peel.rows)
                peel.rows = []
    peel.finish()
    yield _batch(peel.rows)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that were parts, deepest first: each is complete when it comes, and is merged into its parent."""
    below: dict[bytes, list[int]] = {}
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            children, leaves, saved = below.pop(row["node"], (0, 0, 0))
            children += row["n_children"]
            leaves = leaves + row["n_leaves"] if children else 1
            saved += row["saved_tokens"] + (row["n_convs"] - 1) * row["n_bytes"]
            if row["parent"] is not None:
                above = below.setdefault(row["parent"], [0, 0, 0])
                above[:] = above[0] + 1, above[1] + leaves, above[2] + saved
            row |= {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
            done.append(tuple(row[name] for name, _, _ in _NODE[1:11]))
        yield _batch(done, _NODE[1:11])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node, its blocks coming in order; a block is held at a time."""
    columns = [("node", pa.binary(), ""), ("ends_sha256", pa.string(), "")]
    node, digest = None, None
    for batch in batches:
        done = []
        for key, block in zip(batch.column("node").to_pylist(), batch.column("block").to_pylist()):
            if key == node:
                digest.update(b"," + block)
            else:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(block)
        yield _batch(done, columns)
    if node is not None:
        yield _batch([(node, digest.hexdigest())], columns)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """`sequences(conv_id, path)`, each conv_id once -> one row for each node: node and parent (16-byte keys of the turns up to there),
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The root has depth 0 and all members, those without turns too; no conversations give no rows. The conversations that end at one
    node are hashed one after the other, as the digest wants it, in blocks; all else that a hot prefix holds is spread.
    """
    work = Workspace(sequences.sparkSession, "prefix-trie")
    sequences = work.table(sequences, "sequences")
    ordered = sequences.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    peeled = work.table(ordered.mapInArrow(_peel, NODE_ROW), "peeled")
    names = [name for name, _, _ in _NODE[1:11]]
    # At most two paths of each task of the peel.
    parts = peeled.filter("not whole").groupBy("node").agg(
        *[F.first(name).alias(name) for name in ("parent", "depth", "n_bytes")], F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in _SUMS], F.max("ends_sha256").alias("ends_sha256"),
    )
    parts = parts.select(*names).coalesce(1).sortWithinPartitions(F.col("depth").desc())
    joined = parts.mapInArrow(_put_together, ", ".join(f"{name} {kind}" for name, _, kind in _NODE[1:11]))
    nodes = work.table(peeled.filter("whole").select(*names).unionByName(joined), "nodes")
    blocks = peeled.filter("block is not null").repartition("node").sortWithinPartitions("node", "block_start")
    digests = blocks.select("node", "block").mapInArrow(_digests, "node binary, ends_sha256 string")
    missing = nodes.filter("ends_sha256 is null").drop("ends_sha256").join(digests, "node", "left")
    missing = missing.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    every = nodes.filter("ends_sha256 is not null").unionByName(missing)
    parents = nodes.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["node", "parent", "conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256"]
    return every.join(parents, "parent", "left").select(*columns)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table `(conv_id, turn, role, text, ...)`. Extra columns are ignored, whatever their names."""
    work = Workspace(conversations.sparkSession, "conversation-paths")
    return prefix_trie(rebuilt(work.table(paths(conversations), "own")))
