"""Benchmark decontamination: size-partitioned MinHash containment search with an exact check.

A short item inside a long document has a tiny Jaccard similarity to the whole of it, so items are partitioned by
size, and for each partition a document is seen as overlapping windows little longer than its items. One shared
minimum of HASHES makes a candidate: an item held whole has a similarity of at least 0.4 to one window and is missed
with a chance of 8e-8, one of which 80 % is held in one place with 2e-5. Candidates are decided by counting the
item's shingles in the whole document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from landfall.llm import words
from landfall.llm.frames import Workspace, map_batches, text_bytes, with_text_hash, without

HASHES, SHINGLE, PERCENT = 32, 5, 80
# Items go to the tasks in blocks of about this many bytes of text, each searched for in all documents.
ITEM_BYTES = 8 << 20
# Shingles that are searched at once; longer texts in pieces, short ones together.
PIECE = 1 << 15
SMALLEST = 16
_FACTORS = (words.mix(np.arange(101, 101 + HASHES, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SPREAD = np.uint32(0x9E3779B1)
_TABLE = 16


def _minhashes(shingle_codes: np.ndarray) -> np.ndarray:
    return (shingle_codes >> np.uint64(32)).astype(np.uint32)[None, :] * _FACTORS[:, None]


class Index:
    """The items of one block by size partition: sorted (hash number, minimum) pairs, and a bit table before them."""

    def __init__(self, items: list[tuple[object, bytes]], shingle: int) -> None:
        self.ids, self.sets, by_size = [], [], {}
        for item_id, text in items:
            hashes = words.word_hashes(text)
            if len(hashes) < shingle:
                continue
            own = np.unique(words.shingles(hashes, shingle))
            size = max(SMALLEST, 1 << int(len(own) - 1).bit_length())
            by_size.setdefault(size, []).append(len(self.ids))
            self.ids.append(item_id)
            self.sets.append(own)
        self.parts = []
        for size, members in sorted(by_size.items()):
            least = np.array([_minhashes(self.sets[m]).min(axis=1) for m in members])
            keys = (np.arange(HASHES, dtype=np.uint64)[None, :] << np.uint64(32) | least).ravel()
            owners = np.repeat(np.array(members), HASHES)
            order = np.argsort(keys, kind="stable")
            table = np.zeros((HASHES, 1 << _TABLE), bool)
            table[np.arange(HASHES)[None, :], (least * _SPREAD) >> np.uint32(32 - _TABLE)] = True
            self.parts.append((size, keys[order], owners[order], table))

    def longest(self) -> int:
        return max((size for size, *_ in self.parts), default=0) * 5 // 4

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first shingle, one past the last, item) of windows that share a minimum with an item."""
        minima, width = _minhashes(codes), 1
        found = [(np.empty(0, np.int64),) * 3]
        for size, keys, owners, table in self.parts:
            while width < size // 4:  # minima of blocks twice as wide
                if minima.shape[1] % 2:
                    minima = np.concatenate((minima, minima[:, -1:]), axis=1)
                minima, width = np.minimum(minima[:, 0::2], minima[:, 1::2]), width * 2
            least = minima
            for i in range(1, 5):  # five blocks are one window
                shifted = np.concatenate((minima[:, i:], np.repeat(minima[:, -1:], min(i, minima.shape[1]), axis=1)), axis=1)
                least = np.minimum(least, shifted)
            number, window = np.nonzero(np.take_along_axis(table, ((least * _SPREAD) >> np.uint32(32 - _TABLE)).astype(np.int64), axis=1))
            wanted = number.astype(np.uint64) << np.uint64(32) | least[number, window]
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            lengths = high - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
            start = np.repeat(window * width, lengths)
            found.append((start, start + 5 * width, owners[at]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _pieces(texts: list[np.ndarray]):
    """Runs of texts that have about PIECE shingles together: (first, one past the last)."""
    first, held = 0, 0
    for i, codes in enumerate(texts):
        held += len(codes)
        if held >= PIECE:
            yield first, i + 1
            first, held = i + 1, 0
    if held:
        yield first, len(texts)


def search(index: Index, texts: list[np.ndarray], percent: int) -> list[tuple[int, int, int]]:
    """(text, item, shared shingles) of texts that hold enough of an item."""
    found = []
    for first, last in _pieces(texts):
        codes = np.concatenate(texts[first:last])
        ends = np.cumsum([len(x) for x in texts[first:last]])
        pairs: set[tuple[int, int]] = set()
        for at in range(0, len(codes), PIECE):
            start, end, item = index.candidates(codes[at : at + PIECE + index.longest()])
            low, high = np.searchsorted(ends, start + at, "right"), np.searchsorted(ends, np.minimum(end + at, len(codes)) - 1, "right")
            pairs.update((t, i) for a, b, i in set(zip(low.tolist(), high.tolist(), item.tolist())) for t in range(a, b + 1))
        by_text: dict[int, list[int]] = {}
        for t, i in pairs:
            by_text.setdefault(t, []).append(i)
        for t, items in sorted(by_text.items()):
            own = np.unique(texts[first + t])
            for i in sorted(items):
                item = index.sets[i]
                at = np.minimum(np.searchsorted(own, item), len(own) - 1) if len(own) else None
                shared = int((own[at] == item).sum()) if len(own) else 0
                if 100 * shared >= percent * len(item):
                    found.append((first + t, i, shared))
    return found


def contained(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs(doc_id, text, ...)`, `benchmark(item_id, text, ...)` -> one row for each document row and item of which it
    holds at least `percent` % of the distinct `shingle`-word shingles: doc_id, text_hash (of Spark), item_id,
    n_item_shingles, n_shared, containment.

    Words compare with A-Z lower-cased. Items of fewer words than a shingle, or null, prove nothing and are
    never found; null, empty and short texts hold nothing. Equal rows of `benchmark` count once, repeated rows of `docs`
    each. Extra columns are ignored; no documents or no items give no rows. The documents are never shuffled:
    items are sent to them in blocks of bounded size.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "containment")
    items = work.table(benchmark.select("item_id", "text").filter("text is not null").distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // ITEM_BYTES) or 1
    id_type, item_type = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (items, "item_id")))
    schema = f"doc_id {id_type}, text_hash long, item_id {item_type}, n_item_shingles long, n_shared long"
    rows = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = spark.sparkContext.broadcast(Index([(r.item_id, r.text.encode()) for r in own], shingle))
        rows.append(map_batches(with_text_hash(docs.select("doc_id", "text")), _search(index, shingle, percent, to_arrow_type(items.schema["item_id"].dataType)), schema))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def _search(broadcast, shingle: int, percent: int, item_type: pa.DataType):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = broadcast.value
        hashes = (words.word_hashes(text) for text in text_bytes(batch))
        texts = [words.shingles(h if len(h) >= shingle else h[:0], shingle) for h in hashes]
        found = search(index, texts, percent) if index.ids else []
        at = pa.array([t for t, _, _ in found], pa.int64())
        columns = [batch.column(c).take(at) for c in ("doc_id", "text_hash")]
        columns.append(pa.array([index.ids[i] for _, i, _ in found], item_type))
        columns.append(pa.array([len(index.sets[i]) for _, i, _ in found], pa.int64()))
        columns.append(pa.array([shared for _, _, shared in found], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "item_id", "n_item_shingles", "n_shared"])

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns, whatever their names. Null and empty texts hold none, and rows
    that repeat a doc_id and text go or stay together."""
    work = Workspace(docs.sparkSession, "decontaminated")
    rejected = work.table(contained(docs, benchmark).select("doc_id", "text_hash").distinct(), "rejected")
    return without(docs, rejected)
