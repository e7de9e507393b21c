"""What becomes of a document: one outcome per entry, decided row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall import schema
from landfall.functions import dates, passengers, values
from landfall.functions.once import once

OK, ALREADY_PROCESSED = "ok", "already_processed"
BAD_JSON, BAD_SCHEDULE, BAD_ROW = "bad_json", "bad_schedule", "bad_row"

VOYAGE_TEXTS = {
    "event_code": "EventCode",
    "arrival_port_code": "ArrivalPortCode",
    "departure_port_code": "DeparturePortCode",
    "carrier_code": "CarrierCode",
}
PASSENGER_TEXTS = {
    "document_type": "DocumentType",
    "document_issuing_country_code": "DocumentIssuingCountryCode",
    "eea_flag": "NationalityCountryEEAFlag",
    "disembarkation_port_code": "DisembarkationPortCode",
    "in_transit_flag": "InTransitFlag",
    "disembarkation_port_country_code": "DisembarkationPortCountryCode",
    "nationality_country_code": "NationalityCountryCode",
    "passenger_identifier": "PassengerIdentifier",
}


def _any(tests) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def _too_long(text: Column, limit: int) -> Column:
    return F.coalesce(F.length(text) > limit, F.lit(False))


def _passenger_breaks_limits(p: Column) -> Column:
    age = values.age_or_default(p["Age"])
    return _any(
        [_too_long(p[key], schema.FACT_TEXT_LIMITS[column]) for column, key in PASSENGER_TEXTS.items()]
        + [(age < schema.SMALLINT_MIN) | (age > schema.SMALLINT_MAX)]
    )


def fact_limits_broken(manifest: Column, best: Column, json_file_name: Column) -> Column:
    """Some fact row would not fit its columns. Without passengers there is no fact row."""
    voyage = _any(
        [_too_long(manifest[key], schema.FACT_TEXT_LIMITS[column]) for column, key in VOYAGE_TEXTS.items()]
        + [_too_long(json_file_name, schema.FACT_TEXT_LIMITS["json_file"])]
    )
    return F.coalesce((F.size(best) > 0) & (voyage | F.exists(best, _passenger_breaks_limits)), F.lit(False))


def ledger_limits_broken(manifest: Column, counts: list[Column], names: dict[str, Column]) -> Column:
    limits = schema.JSON_LEDGER_TEXT_LIMITS
    return _any(
        [_too_long(manifest[key], limits[column]) for column, key in VOYAGE_TEXTS.items()]
        + [_too_long(text, limits[column]) for column, text in names.items()]
        + [F.coalesce(count > schema.SMALLINT_MAX, F.lit(False)) for count in counts]
    )


@once
def _assessment() -> list[dict[str, Column]]:
    manifest = F.col("manifest")
    best = F.col("best_passengers")
    counts = [F.col(name) for name in schema.COUNT_COLUMNS]
    return [
        {
            "scheduled": dates.scheduled(
                manifest["ScheduledDateOfArrival"], manifest["ScheduledTimeOfArrival"]
            ),
            "voyage_number": values.strict_int(manifest["VoyageNumber"]),
            "best_passengers": passengers.best(manifest["PassengerList"]),
            "created_on": dates.created_on(F.col("zip_file_name")),
            **passengers.ingest_counts(manifest["PassengerList"]),
        },
        {
            "best_count": F.size(best),
            "fact_limits_broken": fact_limits_broken(manifest, best, F.col("json_file_name")),
            "ledger_limits_broken": ledger_limits_broken(
                manifest, counts, {n: F.col(n) for n in ("zip_file_name", "json_file_name")}
            ),
            # The flag needs the archive's date; a dated name with no calendar date has none.
            "_undatable": F.col("created_on").isNotNull()
            & F.col("created_on").try_cast("date").isNull(),
        },
        {
            "verdict": F.when(~F.col("parse_ok"), BAD_JSON)
            .when(F.col("scheduled").isNull(), BAD_SCHEDULE)
            .when(
                (F.col("voyage_number").isNull() & (F.col("best_count") > 0))
                | F.col("fact_limits_broken")
                | F.col("ledger_limits_broken")
                | F.col("_undatable"),
                BAD_ROW,
            )
            .otherwise(OK)
        },
    ]


def assess(parsed: DataFrame) -> DataFrame:
    """Add the voyage columns, the best passengers and their number, the summary counts and `verdict`: the
    outcome the document would have if it were new. No shuffle."""
    return reduce(lambda rows, added: rows.withColumns(added), _assessment(), parsed).drop("_undatable")


def with_outcome(marked: DataFrame) -> DataFrame:
    """Add `outcome` from `verdict` and `already_processed`; header rows get none."""
    return marked.withColumn(
        "outcome",
        F.when(F.col("entry_index").isNull(), F.lit(None))
        .when(F.col("already_processed"), ALREADY_PROCESSED)
        .otherwise(F.col("verdict")),
    )


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("outcome").isin(BAD_JSON, BAD_SCHEDULE, BAD_ROW))
