"""File-name feed: what to read next, given the last name handled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import dates


def list_after(names: DataFrame, marker: str) -> DataFrame:
    """Names after the marker, which is itself excluded, in name order."""
    return names.filter(F.col("zip_file_name") > marker).orderBy("zip_file_name")


def without_marker(names: DataFrame, marker: str) -> DataFrame:
    """Drop every name that contains the marker; an empty marker drops nothing."""
    return names.filter(~F.contains("zip_file_name", F.lit(marker))) if marker else names


def next_marker(names: DataFrame, marker: str) -> DataFrame:
    """One row: the largest name to be read, or the old marker where there is none."""
    return without_marker(names, marker).agg(
        F.coalesce(F.max("zip_file_name"), F.lit(marker)).alias("next_marker")
    )


def last_persisted_file(zip_ledger: DataFrame) -> DataFrame:
    return zip_ledger.agg(F.max("zip_file_name").alias("last_file"))


def bootstrap_marker(zip_ledger: DataFrame, as_of: Column) -> DataFrame:
    """Resume after the last recorded archive, or from the day before `as_of` with an empty ledger."""
    yesterday = dates.yymmdd(dates.shifted(as_of, -24 * 60 * 60))
    start = F.concat(F.lit("drt_dq_"), yesterday, F.lit("_000000_0000.zip"))
    return last_persisted_file(zip_ledger).select(
        F.coalesce("last_file", start).alias("marker")
    )
