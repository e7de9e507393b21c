"""Numbers and flags read from document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_int(text: Column) -> Column:
    """Whole number in int range, null otherwise. A bare cast would trim blanks and accept them."""
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("int"))


def age_or_default(text: Column) -> Column:
    return F.coalesce(strict_int(text), F.lit(-1))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def in_transit(flag: Column) -> Column:
    """Stored flag: exactly Y."""
    return F.coalesce(flag == "Y", F.lit(False))


def mentions_transit(flag: Column) -> Column:
    """Flag used by the counts taken at ingest: Y anywhere in the text."""
    return F.coalesce(F.contains(flag, F.lit("Y")), F.lit(False))
