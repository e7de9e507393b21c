"""Passenger sub-lists and counts over the nested list, without exploding it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.values import mentions_transit


def has_identifier(passenger: Column) -> Column:
    return F.coalesce(passenger["PassengerIdentifier"] != "", F.lit(False))


def interactive(passengers: Column) -> Column:
    return F.filter(passengers, has_identifier)


def non_interactive(passengers: Column) -> Column:
    return F.filter(passengers, lambda p: ~has_identifier(p))


def has_interactive(passengers: Column) -> Column:
    return F.exists(passengers, has_identifier)


def best(passengers: Column) -> Column:
    """The interactive passengers, or everybody where there is none."""
    return F.when(has_interactive(passengers), interactive(passengers)).otherwise(passengers)


def ingest_counts(passengers: Column) -> dict[str, Column]:
    """The four summary counts over the whole list, keyed by ledger column."""
    def count(keep) -> Column:
        return F.size(F.filter(passengers, keep))

    def transit(p: Column) -> Column:
        return mentions_transit(p["InTransitFlag"])

    return {
        "non_interactive_total_count": count(lambda p: ~has_identifier(p)),
        "non_interactive_trans_count": count(lambda p: ~has_identifier(p) & transit(p)),
        "interactive_total_count": count(has_identifier),
        "interactive_trans_count": count(lambda p: has_identifier(p) & transit(p)),
    }
