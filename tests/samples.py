"""Small manifests, archives and table rows for the tests."""

from __future__ import annotations

import io
import json
import warnings
import zipfile
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schema


def passenger(identifier: str | None = None, **changes) -> dict:
    p = {
        "DocumentType": "P",
        "DocumentIssuingCountryCode": "GBR",
        "NationalityCountryEEAFlag": "Y",
        "Age": "22",
        "DisembarkationPortCode": "LHR",
        "InTransitFlag": "N",
        "DisembarkationPortCountryCode": "GBR",
        "NationalityCountryCode": "GBR",
    }
    if identifier is not None:
        p["PassengerIdentifier"] = identifier
    p.update(changes)
    return {key: value for key, value in p.items() if value is not ...}


def manifest(passengers: list | None = None, date="2022-06-01", time="10:00", **changes) -> dict:
    m = {
        "EventCode": "DC",
        "ArrivalPortCode": "LHR",
        "DeparturePortCode": "JFK",
        "VoyageNumber": "1000",
        "CarrierCode": "BA",
        "ScheduledDateOfArrival": date,
        "ScheduledTimeOfArrival": time,
        "VoyageKey": "ignored",
        "PassengerList": [passenger("1")] if passengers is None else passengers,
    }
    m.update(changes)
    return {key: value for key, value in m.items() if value is not ...}


def archive(entries: list[tuple[str, dict | str | bytes]]) -> bytes:
    buffer = io.BytesIO()
    with warnings.catch_warnings(), zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        warnings.simplefilter("ignore")
        for name, content in entries:
            z.writestr(name, json.dumps(content) if isinstance(content, dict) else content)
    return buffer.getvalue()


def files(spark: SparkSession, archives: dict[str, bytes]) -> DataFrame:
    rows = [(name, bytearray(content)) for name, content in archives.items()]
    return spark.createDataFrame(rows, "zip_file_name string, content binary")


def rows_of(spark: SparkSession, archives: dict[str, list[tuple[str, dict | str]]]) -> DataFrame:
    """Header and entry rows without going through zip bytes."""
    rows = []
    for name, entries in archives.items():
        rows.append((name, True, None, None, None))
        for index, (json_name, content) in enumerate(entries):
            text = json.dumps(content) if isinstance(content, dict) else content
            rows.append((name, True, index, json_name, text))
    return spark.createDataFrame(
        rows,
        "zip_file_name string, zip_ok boolean, entry_index bigint, json_file_name string, content string",
    )


def at(text: str):
    return F.lit(text).cast("timestamp")


def _fill(spark: SparkSession, table_schema, rows: list[dict]) -> DataFrame:
    names = table_schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], table_schema)


def json_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {"suspicious_date": False, "success": True, "processed_at": datetime(2021, 1, 1)}
    return _fill(spark, schema.JSON_LEDGER, [base | row for row in rows])


def zip_rows(spark: SparkSession, rows: list[tuple[str, str | None]], success=True) -> DataFrame:
    full = [
        {"zip_file_name": n, "success": success, "processed_at": datetime(2021, 1, 1), "created_on": d}
        for n, d in rows
    ]
    return _fill(spark, schema.ZIP_LEDGER, full)


def fact_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "event_code": "DC", "arrival_port_code": "LHR", "departure_port_code": "JFK", "voyage_number": 1000,
        "carrier_code": "BA", "scheduled_date": datetime(2024, 4, 22, 10, 30), "day_of_week": 1,
        "week_of_year": 17, "document_type": "P", "document_issuing_country_code": "GBR", "eea_flag": "Y",
        "age": 22, "disembarkation_port_code": "LHR", "in_transit_flag": "N",
        "disembarkation_port_country_code": "GBR", "nationality_country_code": "GBR",
        "passenger_identifier": "123", "in_transit": False, "json_file": "test.json",
    }
    return _fill(spark, schema.PASSENGER_FACT, [base | row for row in rows])
