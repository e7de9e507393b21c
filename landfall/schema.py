"""Declared shapes: the raw manifest document and the three stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Keys of the manifest document that are read; any other key is ignored.
VOYAGE_KEYS = [
    "EventCode",
    "ArrivalPortCode",
    "DeparturePortCode",
    "VoyageNumber",
    "CarrierCode",
    "ScheduledDateOfArrival",
    "ScheduledTimeOfArrival",
]
PASSENGER_LIST = "PassengerList"
REQUIRED_PASSENGER_KEYS = [
    "DocumentIssuingCountryCode",
    "NationalityCountryEEAFlag",
    "InTransitFlag",
]
OPTIONAL_PASSENGER_KEYS = [
    "DocumentType",
    "Age",
    "DisembarkationPortCode",
    "DisembarkationPortCountryCode",
    "NationalityCountryCode",
    "PassengerIdentifier",
]
PASSENGER_KEYS = REQUIRED_PASSENGER_KEYS + OPTIONAL_PASSENGER_KEYS

# The longest text each stored column takes, and the range of a stored small integer.
FACT_TEXT_LIMITS = {
    "event_code": 2,
    "arrival_port_code": 5,
    "departure_port_code": 5,
    "carrier_code": 5,
    "document_type": 50,
    "document_issuing_country_code": 5,
    "eea_flag": 5,
    "disembarkation_port_code": 5,
    "in_transit_flag": 2,
    "disembarkation_port_country_code": 5,
    "nationality_country_code": 5,
    "passenger_identifier": 25,
    "json_file": 50,
}
JSON_LEDGER_TEXT_LIMITS = {
    "zip_file_name": 50,
    "json_file_name": 50,
    "arrival_port_code": 5,
    "departure_port_code": 5,
    "carrier_code": 5,
    "event_code": 3,
}
SMALLINT_MIN, SMALLINT_MAX = -32768, 32767


def _leaf_document(leaf: T.DataType) -> T.StructType:
    passenger = T.StructType([T.StructField(key, leaf) for key in PASSENGER_KEYS])
    return T.StructType(
        [T.StructField(key, leaf) for key in VOYAGE_KEYS]
        + [T.StructField(PASSENGER_LIST, T.ArrayType(passenger))]
    )


# VARIANT leaves keep the JSON type of each value, which a string leaf would lose.
RAW_DOCUMENT = _leaf_document(T.VariantType())
MANIFEST = _leaf_document(T.StringType())

ENTRY = T.StructType(
    [
        T.StructField("zip_file_name", T.StringType()),
        T.StructField("entry_index", T.LongType()),
        T.StructField("json_file_name", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

PASSENGER_FACT = T.StructType(
    [
        T.StructField("event_code", T.StringType()),
        T.StructField("arrival_port_code", T.StringType()),
        T.StructField("departure_port_code", T.StringType()),
        T.StructField("voyage_number", T.IntegerType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("scheduled_date", T.TimestampType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("document_issuing_country_code", T.StringType()),
        T.StructField("eea_flag", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("disembarkation_port_code", T.StringType()),
        T.StructField("in_transit_flag", T.StringType()),
        T.StructField("disembarkation_port_country_code", T.StringType()),
        T.StructField("nationality_country_code", T.StringType()),
        T.StructField("passenger_identifier", T.StringType()),
        T.StructField("in_transit", T.BooleanType()),
        T.StructField("json_file", T.StringType()),
    ]
)

VOYAGE_COLUMNS = [
    "arrival_port_code",
    "departure_port_code",
    "voyage_number",
    "carrier_code",
    "scheduled",
    "event_code",
]
COUNT_COLUMNS = [
    "non_interactive_total_count",
    "non_interactive_trans_count",
    "interactive_total_count",
    "interactive_trans_count",
]

JSON_LEDGER = T.StructType(
    [
        T.StructField("zip_file_name", T.StringType()),
        T.StructField("json_file_name", T.StringType()),
        T.StructField("suspicious_date", T.BooleanType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("arrival_port_code", T.StringType()),
        T.StructField("departure_port_code", T.StringType()),
        T.StructField("voyage_number", T.IntegerType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("scheduled", T.TimestampType()),
        T.StructField("event_code", T.StringType()),
        T.StructField("non_interactive_total_count", T.IntegerType()),
        T.StructField("non_interactive_trans_count", T.IntegerType()),
        T.StructField("interactive_total_count", T.IntegerType()),
        T.StructField("interactive_trans_count", T.IntegerType()),
    ]
)

ZIP_LEDGER = T.StructType(
    [
        T.StructField("zip_file_name", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("created_on", T.StringType()),
    ]
)
