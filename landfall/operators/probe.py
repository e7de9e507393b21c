"""Which rows may have a partner, by a bitmap of fixed size, so that the others need no join.

The keys of the smaller side are hashed to one of BITS bits. The bitmap is broadcast whatever the number of keys, since it never
takes more than BITS / 8 bytes; a row whose bit is not set has no partner for certain and stays where it is. Only the others go through
the exact join. With very many keys the bitmap fills up and more rows take the join: the result is the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 8 MB, in maps of the size that Spark's aggregate makes.
BITS, MAP_BITS = 1 << 26, 32_768


def bitmap(keys: DataFrame, hashed: Column) -> DataFrame:
    """`number`, `bits`: at most BITS / MAP_BITS maps of the keys' hashes, longs."""
    place = F.pmod(hashed, F.lit(BITS))
    number = F.floor(place / MAP_BITS).cast("int")
    return keys.groupBy(number.alias("number")).agg(F.bitmap_construct_agg(place % MAP_BITS).alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def split(rows: DataFrame, hashed: Column, maps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that have no partner for certain, and those that may have one; all their columns stay, whatever their names."""
    unused = uuid.uuid4().hex
    place, number, bits = (f"{name}_{unused}" for name in ("place", "number", "bits"))
    known = F.broadcast(maps.select(F.col("number").alias(number), F.col("bits").alias(bits)))
    placed = rows.withColumn(place, F.pmod(hashed, F.lit(BITS)))
    joined = placed.join(known, F.floor(F.col(place) / MAP_BITS).cast("int") == F.col(number), "left")
    possible = _is_set(F.col(bits), F.col(place) % MAP_BITS)
    return tuple(joined.filter(keep).select(*[F.col(f"`{c}`") for c in rows.columns]) for keep in (~possible, possible))


def without_pairs(rows: DataFrame, recorded: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key, compared by equality, is not recorded. Null keys are equal to none and stay."""
    certain, possible = split(rows, F.xxhash64(*key), bitmap(recorded, F.xxhash64(*key)))
    return certain.unionByName(possible.join(recorded, key, "left_anti").select(*rows.columns))
