"""Retention: which date is due, which documents go, and what remains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import dates


def oldest_date(zip_ledger: DataFrame) -> DataFrame:
    return zip_ledger.agg(F.min("created_on").alias("oldest_date"))


def retention_target(zip_ledger: DataFrame, as_of: Column, years: int) -> DataFrame:
    """One row: the oldest archive date, and the date to purge (null where it is to be kept)."""
    expired = dates.is_beyond_retention(F.col("oldest_date"), as_of, years)
    return oldest_date(zip_ledger).select(
        "oldest_date", F.when(expired, F.col("oldest_date")).alias("purge_date")
    )


def with_expiry(zip_ledger: DataFrame, as_of: Column, years: int) -> DataFrame:
    expired = dates.is_beyond_retention(F.col("created_on"), as_of, years)
    return zip_ledger.withColumn("expired", F.coalesce(expired, F.lit(False)))


def purge_batch(json_ledger: DataFrame, zip_ledger: DataFrame, date: str, limit: int) -> DataFrame:
    """The first `limit` document names of the date, in order and with repeats; and the date."""
    archives = zip_ledger.filter(F.col("created_on") == date).select("zip_file_name", "created_on")
    return (
        json_ledger.select("zip_file_name", "json_file_name")
        .join(archives, "zip_file_name")
        .select("json_file_name", "created_on")
        .orderBy("json_file_name")
        .limit(limit)
    )


def _by_name(rows: DataFrame, names: DataFrame, column: str, how: str) -> DataFrame:
    return rows.join(names.select(F.col("json_file_name").alias(column)).distinct(), column, how)


def remaining_facts(facts: DataFrame, names: DataFrame) -> DataFrame:
    return _by_name(facts, names, "json_file", "left_anti").select(*facts.columns)


def remaining_json(json_ledger: DataFrame, names: DataFrame) -> DataFrame:
    """Deletion goes by name alone, so rows of the same name under another date go as well."""
    return _by_name(json_ledger, names, "json_file_name", "left_anti").select(*json_ledger.columns)


def closing_date(zip_ledger: DataFrame, names: DataFrame, date: str, limit: int) -> DataFrame:
    """The date as one row if this batch is its last (fewer names than the limit), else no row."""
    dated = zip_ledger.filter(F.col("created_on") == date).select("created_on").distinct()
    counted = names.groupBy("created_on").agg(F.count("*").alias("_n"))
    return (
        dated.join(F.broadcast(counted), "created_on", "left")
        .filter(F.coalesce("_n", F.lit(0)) < limit)
        .select("created_on")
    )


def remaining_zips(zip_ledger: DataFrame, names: DataFrame, date: str, limit: int) -> DataFrame:
    closing = F.broadcast(closing_date(zip_ledger, names, date, limit))
    return zip_ledger.join(closing, "created_on", "left_anti").select(*zip_ledger.columns)


def purge_counts(
    facts: DataFrame,
    json_ledger: DataFrame,
    zip_ledger: DataFrame,
    names: DataFrame,
    date: str,
    limit: int,
) -> DataFrame:
    """One row: deleted facts, documents and archives."""
    closing = F.broadcast(closing_date(zip_ledger, names, date, limit))
    gone = [
        ("deleted_manifests", _by_name(facts.select("json_file"), names, "json_file", "left_semi")),
        (
            "deleted_jsons",
            _by_name(json_ledger.select("json_file_name"), names, "json_file_name", "left_semi"),
        ),
        ("deleted_zips", zip_ledger.select("created_on").join(closing, "created_on", "left_semi")),
    ]
    counted = None
    for label, rows in gone:
        one = rows.agg(F.count("*").alias("n")).withColumn("label", F.lit(label))
        counted = one if counted is None else counted.unionByName(one)
    return counted.agg(
        *[F.sum(F.when(F.col("label") == label, F.col("n"))).alias(label) for label, _ in gone]
    )


def without_key(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Delete by one key; a null key is not equal to it and stays."""
    return rows.filter(~F.coalesce(F.col(column) == key, F.lit(False)))
