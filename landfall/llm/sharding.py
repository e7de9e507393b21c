"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends from regions to racks to shards. At each level every child draws an exponential number, hashed from
the row's key and the child's own name and divided by the child's weight, and the smallest draw wins, so a child wins
in proportion to its weight. A draw depends on nothing but key, name and weight: where weights change, rows move only
into subtrees that gained and out of ones that lost, and all others descend as before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace, unused

SLOT_ROWS = 20_000
LEAST_BUCKETS = 16


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int = 16, racks: int = 2, per_rack: int = 4) -> list[Shard]:
    """Regions of `racks` racks of `per_rack` shards, all of weight 1."""
    return [Shard(i, f"region{i // (racks * per_rack)}", f"rack{i // per_rack % racks}") for i in range(shards)]


def grown(shards: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own: the one subtree whose weight changes, so rows move to the new shard only."""
    number = max(s.number for s in shards) + 1
    return [*shards, Shard(number, f"added{number}", "rack0", weight)]


def _draw(name: str, weight: float, key: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(children: dict[str, list[Shard]], key: Column, below: Callable[[str, list[Shard]], Column]) -> Column:
    """What `below` gives for the child with the smallest draw; children of no weight never win."""
    weights = {name: sum(s.weight for s in members) for name, members in children.items()}
    names = [name for name in children if weights[name] > 0]
    if len(names) == 1:
        return below(names[0], children[names[0]])
    best = F.least(*[F.struct(_draw(name, weights[name], key).alias("draw"), F.lit(i).alias("child")) for i, name in enumerate(names)])
    chosen = best["child"]
    out = F.when(chosen == 0, below(names[0], children[names[0]]))
    for i, name in enumerate(names[1:], 1):
        out = out.when(chosen == i, below(name, children[name]))
    return out


def _by(shards: list[Shard], part: Callable[[Shard], str], above: str) -> dict[str, list[Shard]]:
    out: dict[str, list[Shard]] = {}
    for s in shards:
        out.setdefault(f"{above}/{part(s)}", []).append(s)
    return out


def shard_of(key: Column, shards: list[Shard]) -> Column:
    """The shard number of a key; null keys descend as one key of their own. Some weight must be above 0."""
    if not any(s.weight > 0 for s in shards):
        raise ValueError("no shard has a weight")
    key = F.coalesce(key.cast("string"), F.lit("\x00null"))

    def shard(name: str, members: list[Shard]) -> Column:
        return F.lit(members[0].number)

    def rack(name: str, members: list[Shard]) -> Column:
        return _winner(_by(members, lambda s: str(s.number), name), key, shard)

    def region(name: str, members: list[Shard]) -> Column:
        return _winner(_by(members, lambda s: s.rack, name), key, rack)

    return _winner(_by(shards, lambda s: s.region, ""), key, region)


def sharded(docs: DataFrame, shards: list[Shard] | None = None) -> DataFrame:
    """`docs(doc_id, text, ...)` with all its columns and size, text_crc32, law, shard, slot, grown_shard.

    The law is `key`: doc_id and the shards decide, and with one more shard (grown_shard) rows move only into it. size is
    the text's UTF-8 bytes plus 1; a null text counts as empty. Slots number a shard's rows from 0 without gaps, in the order of
    hash buckets, within them of doc_id, checksum and size; only rows of one doc_id and text can tie, and then it
    makes no difference. Numbering works in buckets of about SLOT_ROWS rows, so no task holds a whole shard. Columns of the
    input that have one of the six new names are replaced, all others stay. Rows of one doc_id all go to one shard.
    """
    shards = shards or topology()
    bucket, number, before = unused("bucket", "number", "before")
    work = Workspace(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.drop("size", "text_crc32", "law", "shard", "slot", "grown_shard").withColumns({
        "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text), "law": F.lit("key"),
        "shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), grown(shards)),
    })
    buckets = max(LEAST_BUCKETS, docs.count() // (len(shards) * SLOT_ROWS))
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    counts = work.table(rows.groupBy("shard", bucket).agg(F.count("*").alias("n")), "counts")
    offsets = counts.select("shard", bucket, (F.sum("n").over(Window.partitionBy("shard").orderBy(bucket)) - F.col("n")).alias(before))
    in_bucket = F.row_number().over(Window.partitionBy("shard", bucket).orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn(number, in_bucket).join(offsets, ["shard", bucket])
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    placed = placed.withColumn("slot", F.col(before) + F.col(number) - 1)
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added], *added)
