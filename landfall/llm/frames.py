"""What the operators share on the Spark side: session settings, written intermediate tables, Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import session
from landfall.operators import probe

# Python gets whole rows; a batch ends at this size, so that only a single longer text makes a larger one.
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


class Workspace:
    """Intermediate tables of one call, in the shared folder. A written table cuts lineage: a lost executor costs
    its running tasks only. The result of a call reads these tables, so they stay until `close()`, or at the latest
    until the driver ends."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = prepare(spark)
        self.path = session.fresh_path(spark, label)
        atexit.register(self.close)

    def table(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def close(self) -> None:
        with contextlib.suppress(Exception):  # the session may have ended, and its folder with it
            session.remove(self.spark, self.path)
        atexit.unregister(self.close)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def map_batches(rows: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One output batch for each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return rows.mapInArrow(run, schema)


def small_or_plain(rows: DataFrame, most: int = 300_000) -> DataFrame:
    """A hint to broadcast narrow rows, given only after they have been counted; beyond `most` the join shuffles."""
    return F.broadcast(rows) if rows.count() <= most else rows


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of doc_id as text, modulo `of`; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64("text"))


def unused(*names: str) -> list[str]:
    """Column names that no table has."""
    mark = uuid.uuid4().hex
    return [f"{name}_{mark}" for name in names]


def among(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """`docs` joined with `keys(doc_id, text_hash, ...)` by doc_id, nulls included, and text; `how` is left_anti, left_semi or inner,
    which adds the further columns of `keys`.

    A bitmap of fixed size tells which texts are not among the keys for certain. Those do not move, however many keys there are.
    """
    own_id, own_hash = unused("id", "hash")
    renamed = keys.withColumnsRenamed({"doc_id": own_id, "text_hash": own_hash})
    hashed = F.xxhash64(F.col(own_id).cast("string"), own_hash)
    maps = probe.bitmap(renamed, hashed)
    certain, possible = probe.split(docs, F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text")), maps)
    same = possible["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(possible["text"]) == F.col(own_hash))
    joined = possible.join(renamed, same, how)
    return certain.union(joined) if how == "left_anti" else joined.drop(own_id, own_hash)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id and text are not among `rejected(doc_id, text_hash)`; all columns stay, whatever their
    names. Rows of a null doc_id or text go like others, repeated rows together; without rejected rows all stay."""
    return among(docs, rejected.select("doc_id", "text_hash").distinct(), "left_anti")
