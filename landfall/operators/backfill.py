"""Summary columns of the JSON ledger, recomputed from the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall import schema
from landfall.functions import dates
from landfall.operators.dedupe import PAIR

# Fact column behind each voyage column of the ledger, in the order that decides between groups.
VOYAGE_SOURCE = {
    "arrival_port_code": "arrival_port_code",
    "departure_port_code": "departure_port_code",
    "voyage_number": "voyage_number",
    "carrier_code": "carrier_code",
    "scheduled": "scheduled_date",
    "event_code": "event_code",
}


def json_with_zip(json_ledger: DataFrame, zip_ledger: DataFrame) -> DataFrame:
    """Documents with the state of their archive; an archive recorded twice gives two rows."""
    archives = zip_ledger.select(
        "zip_file_name", F.col("success").alias("zip_success"), "created_on"
    )
    return json_ledger.join(archives, "zip_file_name")


def manifest_counts(facts: DataFrame) -> DataFrame:
    """Passenger counts per document and voyage. Combined before the shuffle, so a document with very
    many facts arrives as a few rows."""
    identified = F.col("passenger_identifier") != ""
    anonymous = F.col("passenger_identifier") == ""
    transit = F.col("in_transit")
    return facts.groupBy(
        "json_file", *[F.col(source).alias(name) for name, source in VOYAGE_SOURCE.items()]
    ).agg(
        F.count_if(anonymous).alias("non_interactive_total_count"),
        F.count_if(anonymous & transit).alias("non_interactive_trans_count"),
        F.count_if(identified).alias("interactive_total_count"),
        F.count_if(identified & transit).alias("interactive_trans_count"),
    )


def first_summary(counts: DataFrame) -> DataFrame:
    """One voyage per document: the smallest by the voyage columns, nulls last."""
    def ranked() -> list[Column]:
        parts = []
        for name in VOYAGE_SOURCE:
            parts += [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]
        return parts + [F.col(name) for name in schema.COUNT_COLUMNS]

    return (
        counts.groupBy("json_file")
        .agg(F.min(F.struct(*ranked())).alias("s"))
        .select(
            F.col("json_file").alias("json_file_name"),
            *[F.col(f"s.{name}") for name in [*VOYAGE_SOURCE, *schema.COUNT_COLUMNS]],
        )
    )


def rows_to_update(json_ledger: DataFrame, zip_ledger: DataFrame, date: str | None, since: str | None) -> DataFrame:
    """Ledger rows of archives of the date (or of every date from `since` on), each once."""
    dated = zip_ledger.filter(F.col("created_on").isNotNull())
    if date is not None:
        dated = dated.filter(F.col("created_on") == date)
    if since is not None:
        dated = dated.filter(F.col("created_on") >= since)
    return json_ledger.join(dated.select("zip_file_name").distinct(), "zip_file_name", "left_semi")


def updated_rows(
    json_ledger: DataFrame,
    zip_ledger: DataFrame,
    facts: DataFrame,
    date: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """The touched ledger rows with their new voyage columns and counts.

    A pair recorded n times counts its facts n times; a document without facts gets null voyage columns
    and zero counts.
    """
    touched = rows_to_update(json_ledger, zip_ledger, date, since)
    copies = touched.groupBy(*PAIR).agg(F.count("*").alias("_copies"))
    wanted = facts.join(
        touched.select(F.col("json_file_name").alias("json_file")).distinct(), "json_file", "left_semi"
    )
    summary = first_summary(manifest_counts(wanted))
    kept = [n for n in touched.columns if n not in (*schema.VOYAGE_COLUMNS, *schema.COUNT_COLUMNS)]
    counts = [
        (F.coalesce(F.col(name), F.lit(0)) * F.col("_copies")).cast("int").alias(name)
        for name in schema.COUNT_COLUMNS
    ]
    return (
        touched.select(*kept)
        .join(copies, PAIR)
        .join(summary, "json_file_name", "left")
        .select(*kept, *schema.VOYAGE_COLUMNS, *counts)
        .select(*touched.columns)
    )


def earliest_unpopulated(json_ledger: DataFrame, zip_ledger: DataFrame, since: str) -> DataFrame:
    """One row: the first archive date from `since` on with a good document lacking counts, or null."""
    waiting = json_ledger.filter(
        F.col("non_interactive_total_count").isNull() & F.col("success")
    ).select("zip_file_name").distinct()
    archives = zip_ledger.filter(F.col("success") & (F.col("created_on") >= since))
    return archives.join(waiting, "zip_file_name", "left_semi").agg(
        F.min("created_on").alias("earliest_date")
    )


def with_created_on(zip_ledger: DataFrame) -> DataFrame:
    """Fill missing archive dates from fixed positions of the name."""
    return zip_ledger.withColumn(
        "created_on",
        F.coalesce("created_on", dates.created_on_by_position(F.col("zip_file_name"))),
    )
