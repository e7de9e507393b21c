"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents are put in a hashed order and cut into blocks. Its target is met by whole passes over all blocks, and
one pass over so many leading blocks as fit; the block in which the target falls gives single documents. The
block quotas of all sources are split among the output shards down a binary tree: each node draws without
replacement which of its blocks go left, so quotas stay exact at every node and shards come out equal. A shard
then takes its quota from the source's blocks, permuted, and no block goes to two shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace, small_or_plain

WEIGHTS, TOTAL, MOST = (5, 2, 1), 1.5, 2
BLOCK_DOCS, MOST_BLOCKS = 64, 4096
SHARDS = 8
SEED = 20
_KEY = ["named", "name"]


def _order(*what: Column) -> Column:
    """A hashed 32-bit number for a permuted order."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *what), 32)


def _with_key(docs: DataFrame) -> DataFrame:
    source = F.col("source").cast("string")
    return docs.withColumns({"named": source.isNotNull(), "name": F.coalesce(source, F.lit("")), "place": _order(F.col("doc_id"))})


def _block(place: str = "place") -> Column:
    return F.shiftrightunsigned(F.col(place) * F.col("blocks"), 32).alias("block")


def targets(sizes: DataFrame) -> DataFrame:
    """`(named, name, source_size, docs, target)`, one row for each source.

    Sources by code point, null last, weigh WEIGHTS in turn and share TOTAL of all sizes; a target stops at MOST
    times its source's size and the rest is shared anew. That is one water level: targets are weight times level or
    the stop, and the level is the largest of those at which the sources with the lowest stop per weight are full.
    """
    sources = sizes.groupBy(*_KEY).agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.desc("named"), "name")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(rank, F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("stop", F.col("source_size") * float(MOST))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.desc("named"), "name").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * TOTAL - F.coalesce(F.sum("stop").over(by_stop), F.lit(0.0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_stop), F.lit(0.0))
    level = F.max("level").over(every)
    sources = sources.withColumn("level", left / weights).withColumn("target", F.least("stop", F.col("weight") * level))
    return sources.select(*_KEY, "source_size", "docs", "target")


def _split(level: int):
    """A node's quotas, drawn without replacement into its two halves."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["named", "name"], kind="stable").reset_index(drop=True)
        node, quota = int(rows["node"].iloc[0]), rows["quota"].to_numpy(np.int64)
        total = int(quota.sum())
        rng = np.random.default_rng([SEED, level, node])
        take = total // 2 + (rng.integers(2) if total % 2 else 0)
        left = rng.multivariate_hypergeometric(quota, take, method="marginals") if total else quota
        halves = [rows.assign(node=2 * node + side, quota=drawn) for side, drawn in enumerate((left, quota - left))]
        return pd.concat(halves)[["named", "name", "node", "quota"]]

    return split


def shard_quotas(work: Workspace, quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`(named, name, quota)` -> `(named, name, shard, quota)`; `shards` is a power of two. A node holds a row for each source."""
    rows = quotas.withColumn("node", F.lit(0).cast("long")).select("named", "name", "node", "quota")
    for level in range(shards.bit_length() - 1):
        rows = rows.groupBy("node").applyInPandas(_split(level), "named boolean, name string, node long, quota long")
        rows = work.table(rows, f"split-{level}")
    return rows.withColumnRenamed("node", "shard")


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of the block in which a target falls that come nearest to what is missing, larger ones first."""
    rows = rows.sort_values(["size", "place", "doc_id"], ascending=[False, True, True], kind="stable")
    missing, taken = float(rows["missing"].iloc[0]), []
    for size in rows["size"]:
        fits = size <= missing
        taken.append(bool(fits and size > 0))
        missing -= size if taken[-1] else 0
    rows = rows.assign(taken=taken)
    rest = rows[~rows["taken"] & (rows["size"] > 0)]
    if len(rest) and (smallest := rest.iloc[-1])["size"] - missing < missing:  # one too many is nearer than one too few
        rows.loc[smallest.name, "taken"] = True
    return rows[rows["taken"]][["named", "name", "place", "doc_id"]]


class Mix:
    """The plan of a mix over `docs(doc_id, text, source, ...)`; the same rows always give the same plan.

    A document's size is its number of words (null: 0). Null sources are one source. Documents of no words are in a
    mix where their block is, at no size. Rows of one doc_id and source are taken together; equal rows are separate
    documents of one place. Extra columns do no harm. No rows, or no words at all, give an empty mix.
    """

    def __init__(self, docs: DataFrame, shards: int = SHARDS) -> None:
        work = self.work = Workspace(docs.sparkSession, "mixing")
        self.docs = docs
        size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
        self.sizes = work.table(_with_key(docs.select("doc_id", "source", size.alias("size"))), "sizes")
        known = work.table(targets(self.sizes), "targets")
        passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(0)
        known = known.withColumns({
            "blocks": F.least(F.ceil(F.col("docs") / BLOCK_DOCS), F.lit(MOST_BLOCKS)).cast("long"), "passes": passes.cast("long"),
        }).withColumn("missing", F.col("target") - F.col("passes") * F.col("source_size"))
        self.targets = known = work.table(known, "sources")
        placed = self.sizes.join(small_or_plain(known.select(*_KEY, "blocks")), _KEY)
        words = placed.select(*_KEY, _block(), "size").groupBy(*_KEY, "block").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy(*_KEY).orderBy("block"))
        blocks = words.withColumn("upto", upto).join(known.select(*_KEY, "passes", "missing"), _KEY)
        whole = F.col("upto") <= F.col("missing")
        edge = ~whole & (F.col("upto") - F.col("words") < F.col("missing"))
        blocks = work.table(blocks.select(*_KEY, "block", "passes", whole.alias("whole"), edge.alias("edge"), (F.col("missing") - F.col("upto") + F.col("words")).alias("missing")), "blocks")
        edges = blocks.filter("edge").select(*_KEY, "block", "missing")
        near = placed.select(*_KEY, "place", "doc_id", "size", _block()).join(small_or_plain(edges), [*_KEY, "block"])
        near = near.groupBy(*_KEY, "place", "doc_id").agg(F.sum("size").alias("size"), F.max("missing").alias("missing"))
        id_type = docs.schema["doc_id"].dataType.simpleString()
        self.singles = work.table(near.groupBy(*_KEY).applyInPandas(_fill, f"named boolean, name string, place long, doc_id {id_type}"), "singles")
        tokens = self._tokens(blocks)
        quotas = tokens.groupBy(*_KEY).agg(F.count("*").alias("quota"))
        split = shard_quotas(work, quotas, shards)
        ends = F.sum("quota").over(Window.partitionBy(*_KEY).orderBy("shard"))
        ranges = split.select(*_KEY, "shard", (ends - F.col("quota")).alias("low"), ends.alias("high"))
        drawn = F.row_number().over(Window.partitionBy(*_KEY).orderBy(_order(F.col("pass"), F.col("block")), "pass", "block")) - 1
        ranked = tokens.withColumn("drawn", drawn).join(ranges, _KEY).filter("drawn >= low and drawn < high")
        self.tokens = work.table(ranked.select(*_KEY, "block", "pass", "partial", "shard"), "tokens")

    @staticmethod
    def _tokens(blocks: DataFrame) -> DataFrame:
        """One row for each time a block is used; partial where only its singles are."""
        whole = blocks.filter("passes > 0").select(*_KEY, "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).alias("pass"), F.lit(False).alias("partial"))
        last = blocks.filter("whole or edge").select(*_KEY, "block", F.col("passes").alias("pass"), F.col("edge").alias("partial"))
        return whole.unionByName(last)

    def _uses(self, rows: DataFrame) -> DataFrame:
        """`rows(doc_id, named, name, place, ...)` with `uses`, an array of (pass, shard)."""
        use = F.struct("pass", "shard", "partial")
        per_block = self.tokens.groupBy(*_KEY, "block").agg(F.sort_array(F.collect_list(use)).alias("uses"))
        rows = rows.join(small_or_plain(self.targets.select(*_KEY, "source_size", "target", "blocks")), _KEY)
        rows = rows.withColumn("block", _block()).join(small_or_plain(per_block), [*_KEY, "block"], "left")
        single = self.singles.select(F.col("named").alias("_named"), F.col("name").alias("_name"), F.col("place").alias("_place"), F.col("doc_id").alias("_id"))
        same = (F.col("named") == F.col("_named")) & (F.col("name") == F.col("_name")) & (F.col("place") == F.col("_place")) & rows["doc_id"].eqNullSafe(F.col("_id"))
        rows = rows.join(small_or_plain(single), same, "left")
        picked = F.filter("uses", lambda u: ~u["partial"] | F.col("_place").isNotNull())
        return rows.withColumn("uses", F.coalesce(picked, F.array().cast("array<struct<pass:bigint,shard:bigint,partial:boolean>>")))

    def per_document(self) -> DataFrame:
        """One row for each row of the input: doc_id, size, source_size, target, taken, and mix_shards, the output shards it
        was drawn into, in the order of its uses."""
        taken = (F.col("size") * F.size("uses")).cast("long").alias("taken")
        return self._uses(self.sizes).select("doc_id", "size", "source_size", "target", taken, F.transform("uses", lambda u: u["shard"]).alias("mix_shards"))

    def _used(self) -> DataFrame:
        """`doc`, all columns of a document, whatever their names, for each of its uses; mix_pass, mix_shard, mix_order."""
        keyed = _with_key(self.docs.select(F.struct(*[F.col(f"`{c}`") for c in self.docs.columns]).alias("doc"), "doc_id", "source"))
        used = self._uses(keyed).select("doc", F.explode("uses").alias("use"))
        order = _order(F.col("doc.doc_id"), F.col("use.pass"), F.col("use.shard"))
        return used.select("doc", F.col("use.pass").alias("mix_pass"), F.col("use.shard").alias("mix_shard"), order.alias("mix_order"))

    def _shuffled(self) -> DataFrame:
        """The uses, dealt out by shard and put into the shards' order. A shard is many tasks."""
        spread = self._used().repartition("mix_shard", F.pmod("mix_order", F.lit(64)))
        return spread.sortWithinPartitions("mix_shard", "mix_order")

    def rows(self) -> DataFrame:
        """The mix itself: the documents, with all their columns, as often as they are used, with `mix_pass`, the output
        shard `mix_shard` and `mix_order`, by which a shard is shuffled within itself. Columns of the documents that have one of
        these names are left out."""
        added = ["mix_pass", "mix_shard", "mix_order"]
        return self._used().select(*[F.col(f"doc.`{c}`") for c in self.docs.columns if c not in added], *added)

    def documents(self) -> DataFrame:
        """The documents of the mix with their own columns only, as often as they are used, shard after shard in shuffled order."""
        return self._shuffled().select("doc.*")

    def write(self, path: str) -> None:
        """The mix as Parquet, one folder for each output shard, its rows in shuffled order; columns as of `rows()`."""
        added = ["mix_pass", "mix_shard", "mix_order"]
        rows = self._shuffled().select(*[F.col(f"doc.`{c}`") for c in self.docs.columns if c not in added], *added)
        rows.write.partitionBy("mix_shard").parquet(path)
