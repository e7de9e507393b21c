"""Which entries are new: first occurrence in their archive, and not yet in the ledger.

All keys here are narrow (archive name, document name, index). Grouping them collapses repeated pairs
before the shuffle, so one pair holding a large share of the rows does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators import probe

PAIR = ["zip_file_name", "json_file_name"]


def first_occurrence(entries: DataFrame) -> DataFrame:
    """Per archive and document name, the index of the entry that counts."""
    return entries.groupBy(*PAIR).agg(F.min("entry_index").alias("entry_index"))


def recorded_pairs(ledger: DataFrame, archives: DataFrame | None = None) -> DataFrame:
    """Distinct pairs of the ledger, only those of the given archives if there are any."""
    pairs = ledger.select(*PAIR)
    if archives is not None:
        pairs = pairs.join(
            archives.select("zip_file_name").distinct(), "zip_file_name", "left_semi"
        )
    return pairs.distinct()


def unprocessed(entries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Entries whose pair is not in the ledger. Certain newcomers are told by a bitmap and not shuffled."""
    return probe.without_pairs(entries, recorded_pairs(ledger), PAIR)


def with_recorded_flag(pairs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Add `processed`: is the pair in the ledger? Certain newcomers are told by a bitmap and not shuffled."""
    recorded = recorded_pairs(ledger)
    certain, possible = probe.split(pairs, F.xxhash64(*PAIR), probe.bitmap(recorded, F.xxhash64(*PAIR)))
    known = recorded.withColumn("_known", F.lit(True))
    judged = possible.join(known, PAIR, "left").withColumn("processed", F.col("_known").isNotNull()).drop("_known")
    return certain.withColumn("processed", F.lit(False)).unionByName(judged)


def exceptions(entries: DataFrame, recorded: DataFrame) -> DataFrame:
    """The pairs that need attention, one row each: repeated in the archive, or recorded before.

    `kept_index` is the entry to process, null where the ledger already has the pair. Usually tiny.
    """
    known = recorded.withColumn("_known", F.lit(True))
    return (
        entries.groupBy(*PAIR)
        .agg(F.min("entry_index").alias("_first"), F.count("*").alias("_n"))
        .join(known, PAIR, "left")
        .filter((F.col("_n") > 1) | F.col("_known").isNotNull())
        .select(*PAIR, F.when(F.col("_known").isNull(), F.col("_first")).alias("kept_index"))
    )


def recorded_exceptions(recorded: DataFrame) -> DataFrame:
    """Exceptions where the source has already counted repeats (`occurrence`)."""
    return recorded.select(*PAIR, F.lit(None).cast("long").alias("kept_index"))


def mark_processed(rows: DataFrame, exceptional: DataFrame) -> DataFrame:
    """Add `already_processed`. The exceptions hold a pair at most once, so no row is multiplied."""
    skipped = F.col("_exceptional").isNotNull() & ~F.coalesce(
        F.col("entry_index") == F.col("kept_index"), F.lit(False)
    )
    if "occurrence" in rows.columns:
        skipped = skipped | F.coalesce(F.col("occurrence") > 1, F.lit(False))
    return (
        rows.join(exceptional.withColumn("_exceptional", F.lit(True)), PAIR, "left")
        .withColumn("already_processed", skipped)
        .drop("_exceptional", "kept_index")
    )
