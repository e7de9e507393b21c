"""Rows of the three tables, from classified entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall import schema
from landfall.functions import dates, values
from landfall.operators import classify

_LEDGER_VOYAGE = {
    "arrival_port_code": "manifest.ArrivalPortCode",
    "departure_port_code": "manifest.DeparturePortCode",
    "voyage_number": "voyage_number",
    "carrier_code": "manifest.CarrierCode",
    "scheduled": "scheduled",
    "event_code": "manifest.EventCode",
}


def each_passenger(documents: DataFrame, passengers: Column, *columns: Column | str) -> DataFrame:
    """The given columns and one passenger `p` per row; a document without passengers yields none.

    A plain explode would make the optimizer derive a filter on the list and move it below the parser, which
    would then parse every document once more for each mention in that filter.
    """
    return documents.select(*columns, F.explode_outer(passengers).alias("p")).filter(
        F.col("p").isNotNull()
    )


def passenger_facts(classified: DataFrame) -> DataFrame:
    """One row per best passenger of each good document; only those are exploded."""
    good = each_passenger(
        classified.filter(F.col("outcome") == classify.OK),
        F.col("best_passengers"),
        F.col("manifest.EventCode").alias("event_code"),
        F.col("manifest.ArrivalPortCode").alias("arrival_port_code"),
        F.col("manifest.DeparturePortCode").alias("departure_port_code"),
        "voyage_number",
        F.col("manifest.CarrierCode").alias("carrier_code"),
        dates.or_epoch(F.col("scheduled")).alias("scheduled_date"),
        F.col("json_file_name").alias("json_file"),
    )
    return good.select(
        "event_code",
        "arrival_port_code",
        "departure_port_code",
        "voyage_number",
        "carrier_code",
        "scheduled_date",
        dates.day_of_week(F.col("scheduled_date")).alias("day_of_week"),
        dates.week_of_year(F.col("scheduled_date")).alias("week_of_year"),
        values.or_empty(F.col("p.DocumentType")).alias("document_type"),
        F.col("p.DocumentIssuingCountryCode").alias("document_issuing_country_code"),
        F.col("p.NationalityCountryEEAFlag").alias("eea_flag"),
        values.age_or_default(F.col("p.Age")).alias("age"),
        values.or_empty(F.col("p.DisembarkationPortCode")).alias("disembarkation_port_code"),
        F.col("p.InTransitFlag").alias("in_transit_flag"),
        values.or_empty(F.col("p.DisembarkationPortCountryCode")).alias("disembarkation_port_country_code"),
        values.or_empty(F.col("p.NationalityCountryCode")).alias("nationality_country_code"),
        values.or_empty(F.col("p.PassengerIdentifier")).alias("passenger_identifier"),
        values.in_transit(F.col("p.InTransitFlag")).alias("in_transit"),
        "json_file",
    )


def json_ledger_rows(classified: DataFrame, processed_at: Column) -> DataFrame:
    """One row per newly handled document; a failed one has no voyage columns and no counts."""
    good = F.col("outcome") == classify.OK
    handled = classified.filter(F.col("outcome") != classify.ALREADY_PROCESSED)
    return handled.select(
        "zip_file_name",
        "json_file_name",
        (good & dates.is_suspicious(F.col("scheduled"), F.col("created_on"))).alias("suspicious_date"),
        good.alias("success"),
        processed_at.alias("processed_at"),
        *[F.when(good, F.col(source)).alias(name) for name, source in _LEDGER_VOYAGE.items()],
        *[F.when(good, F.col(name)).alias(name) for name in schema.COUNT_COLUMNS],
    )


def zip_totals(classified: DataFrame) -> DataFrame:
    """Documents newly handled and newly successful per archive. Header rows bring in archives without
    entries; the counts are combined before the shuffle."""
    outcome = F.col("outcome")
    return classified.groupBy("zip_file_name").agg(
        F.coalesce(F.bool_and("zip_ok"), F.lit(True)).alias("zip_ok"),
        F.count_if(outcome != classify.ALREADY_PROCESSED).alias("total"),
        F.count_if(outcome == classify.OK).alias("successful"),
        F.coalesce(
            F.sum(F.when(outcome == classify.OK, F.col("best_count"))), F.lit(0)
        ).alias("fact_rows"),
        F.count_if(
            (outcome == classify.OK) & dates.is_suspicious(F.col("scheduled"), F.col("created_on"))
        ).alias("suspicious"),
    )


def zip_ledger_rows(totals: DataFrame, processed_at: Column) -> DataFrame:
    return totals.select(
        "zip_file_name",
        (F.col("successful") > 0).alias("success"),
        processed_at.alias("processed_at"),
        dates.created_on(F.col("zip_file_name")).alias("created_on"),
    )


def run_metrics(totals: DataFrame) -> DataFrame:
    """The three counters of a run."""
    return totals.agg(
        F.coalesce(F.sum("successful"), F.lit(0)).alias("manifests_processed"),
        F.count_if(~F.col("zip_ok")).alias("zip_failures"),
        F.count("*").alias("zips_processed"),
    )
