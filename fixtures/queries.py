"""The registered queries. Each runs an operator of the library over whole tables.

Documents are derived from the given tables and written once per session, as the archives a service would
find in its storage. Queries over the three stored tables read what the ingest job has made of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import archives
from fixtures.views import AS_OF, BATCH_AT, Fixture, dated, facts, inputs, instant, json_ledger, zip_ledger
from landfall import schema
from landfall.functions import dates, passengers, values
from landfall.operators import backfill, classify, dedupe, quality, retention, rows
from landfall.plans.ingest import classified
from landfall.sources import documents, feed, tables
from landfall.sources.archives import archive_files, archive_rows

# Parameters of the registered queries; oracle.py uses the same ones.
MARKER = "drt_dq_230701_000000_0000.zip"
PURGE_DATE = "2023-04-03"
SMALL_BATCH, FULL_BATCH = 3, 500
SINCE = "2020-06-01"
RETAINED_YEARS = 5
DELETED_JSON, DELETED_ZIP = "m_58.json", "legacy_000000_1.zip"
FRESHNESS_SECONDS = [300, 200 * 24 * 60 * 60]
ARRIVAL = {"port": "STN", "date": "2021-01-31", "event_code": "DC"}
ROUTE = {"event_code": "DC", "arrival": "MAN", "departure": "P02", "week": 24}
ROUTE_DAY = 0
VOYAGE_WEEK = {"port": "EDI", "event_code": "DC", "voyage_number": 33, "week": 31, "year": 2025}
ROUTE_WEEK = {"event_code": "CI", "arrival": "EDI", "departure": "P13", "week": 33, "year": 2023}
DOCUMENT = {"event_code": "DC", "arrival": "LHR", "document_type": "I", "nationality": "N19", "min_age": 30}

_ENTRY = ["zip_file_name", "entry_index", "json_file_name"]


def _no_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], T.StructType([T.StructField(name, T.StringType()) for name in dedupe.PAIR])
    )


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classified(inputs(spark, sf).archive_rows(), _no_ledger(spark))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return documents.parse(inputs(spark, sf).entries())


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return Fixture(spark, sf).table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))


# --- scans and feed -------------------------------------------------------------------------------

def list_after_marker(spark, sf):
    return feed.list_after(inputs(spark, sf).archive_names().select("zip_file_name"), MARKER)


def next_marker(spark, sf):
    return feed.next_marker(inputs(spark, sf).archive_names(), MARKER)


def bootstrap_marker(spark, sf):
    return feed.bootstrap_marker(zip_ledger(spark, sf), instant(AS_OF))


def last_persisted_file(spark, sf):
    return feed.last_persisted_file(zip_ledger(spark, sf))


def list_files(spark, sf):
    """The names of the zip files after the marker; no file is opened."""
    return archive_files(spark, archives.drop_folder(spark, sf), after=MARKER).select("zip_file_name")


def zip_scan(spark, sf):
    """Zip files in a folder, read as archives."""
    files = archive_files(spark, archives.drop_folder(spark, sf))
    return documents.parse(archive_rows(files)).select(
        "zip_file_name", "zip_ok", "entry_index", "json_file_name", "occurrence",
        F.col("manifest.EventCode").alias("event_code"),
    )


def parse_manifest(spark, sf):
    m = "manifest."
    return _parsed(spark, sf).select(
        *_ENTRY,
        "parse_ok",
        F.col(m + "EventCode").alias("event_code"),
        F.col(m + "ArrivalPortCode").alias("arrival_port_code"),
        F.col(m + "DeparturePortCode").alias("departure_port_code"),
        F.col(m + "VoyageNumber").alias("voyage_number_text"),
        F.col(m + "CarrierCode").alias("carrier_code"),
        F.col(m + "ScheduledDateOfArrival").alias("date_text"),
        F.col(m + "ScheduledTimeOfArrival").alias("time_text"),
        F.size(m + "PassengerList").cast("int").alias("passengers"),
    )


# --- documents to rows ----------------------------------------------------------------------------

def ingest_batch(spark, sf):
    """One whole run after an earlier one: per archive, what was handled and written."""
    source = inputs(spark, sf)
    totals = rows.zip_totals(classified(source.archive_rows(), source.prior_pairs()))
    return totals.withColumns(
        {
            "success": F.col("successful") > 0,
            "created_on": dates.created_on(F.col("zip_file_name")),
        }
    )


def passenger_fact(spark, sf):
    return rows.passenger_facts(_classified(spark, sf))


def json_ledger_rows(spark, sf):
    return rows.json_ledger_rows(_classified(spark, sf), instant(BATCH_AT))


def zip_ledger_rows(spark, sf):
    return rows.zip_ledger_rows(rows.zip_totals(_classified(spark, sf)), instant(BATCH_AT))


def _passenger_list(spark, sf, chosen) -> DataFrame:
    chosen_list = chosen(F.col("manifest.PassengerList"))
    return rows.each_passenger(_parsed(spark, sf), chosen_list, *_ENTRY).select(
        *_ENTRY,
        F.col("p.PassengerIdentifier").alias("passenger_identifier"),
        F.col("p.DocumentType").alias("document_type"),
        F.col("p.InTransitFlag").alias("in_transit_flag"),
    )


def interactive_passengers(spark, sf):
    return _passenger_list(spark, sf, passengers.interactive)


def non_interactive_passengers(spark, sf):
    return _passenger_list(spark, sf, passengers.non_interactive)


def best_passengers(spark, sf):
    return _passenger_list(spark, sf, passengers.best)


def has_interactive(spark, sf):
    return _parsed(spark, sf).select(
        *_ENTRY, passengers.has_interactive(F.col("manifest.PassengerList")).alias("has_interactive")
    )


def ingest_counts(spark, sf):
    return (
        _classified(spark, sf)
        .filter(F.col("outcome") == classify.OK)
        .select(*_ENTRY, *schema.COUNT_COLUMNS)
    )


def classify_outcome(spark, sf):
    return (
        _classified(spark, sf).filter(F.col("entry_index").isNotNull()).select(*_ENTRY, "outcome")
    )


def quarantine_json(spark, sf):
    failed = classify.quarantined(_classified(spark, sf))
    return rows.json_ledger_rows(failed, instant(BATCH_AT))


def suspicious_date(spark, sf):
    return (
        _classified(spark, sf)
        .filter(F.col("outcome") == classify.OK)
        .select(*_ENTRY, dates.is_suspicious(F.col("scheduled"), F.col("created_on")).alias("suspicious_date"))
    )


def schema_limit_violations(spark, sf):
    return classify.assess(_parsed(spark, sf)).select(*_ENTRY, "fact_limits_broken", "ledger_limits_broken")


def zip_totals(spark, sf):
    return rows.zip_totals(_classified(spark, sf))


def run_metrics(spark, sf):
    return rows.run_metrics(rows.zip_totals(_classified(spark, sf)))


def first_occurrence(spark, sf):
    return dedupe.first_occurrence(inputs(spark, sf).keys())


def unprocessed_entries(spark, sf):
    source = inputs(spark, sf)
    return dedupe.unprocessed(source.keys(), source.prior_pairs())


def json_has_been_processed(spark, sf):
    source = inputs(spark, sf)
    return dedupe.with_recorded_flag(source.keys(), source.prior_pairs())


def ledger_after_batch(spark, sf):
    """The JSON ledger as two runs of the ingest job have left it."""
    return json_ledger(spark, sf)


# --- scalar functions -----------------------------------------------------------------------------

def created_on(spark, sf):
    name = F.col("zip_file_name")
    return inputs(spark, sf).archive_names().select(name, dates.created_on(name).alias("created_on"))


def scheduled_ts(spark, sf):
    return _parsed(spark, sf).select(
        *_ENTRY,
        dates.scheduled(
            F.col("manifest.ScheduledDateOfArrival"), F.col("manifest.ScheduledTimeOfArrival")
        ).alias("scheduled"),
    )


def voyage_number(spark, sf):
    return _parsed(spark, sf).select(
        *_ENTRY, values.strict_int(F.col("manifest.VoyageNumber")).alias("voyage_number")
    )


def age_or_default(spark, sf):
    everybody = F.col("manifest.PassengerList")
    return rows.each_passenger(_parsed(spark, sf), everybody, *_ENTRY).select(
        *_ENTRY, F.col("p.Age").alias("age_text"), values.age_or_default(F.col("p.Age")).alias("age")
    )


def dow_week(spark, sf):
    at = F.col("o_orderdate").cast("timestamp")
    return Fixture(spark, sf).table("orders").select(
        "o_orderkey",
        dates.day_of_week(at).alias("day_of_week"),
        dates.week_of_year(at).alias("week_of_year"),
    )


def date_parts(spark, sf):
    at = F.col("ts")
    return _events(spark, sf).select(
        "event_id",
        dates.iso_day_of_week(at).alias("iso_day_of_week"),
        F.year(at).alias("full_year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
        F.minute(at).alias("minute"),
    )


def date_shift(spark, sf):
    at = F.col("ts")
    return _events(spark, sf).select(
        "event_id",
        dates.shifted(at, 36 * 60 * 60).alias("later"),
        dates.shifted(at, -90).alias("earlier"),
    )


def epoch_millis(spark, sf):
    at = F.col("ts")
    return _events(spark, sf).select(
        "event_id",
        F.unix_millis(at).alias("millis"),
        F.timestamp_millis(F.unix_millis(at)).alias("from_millis"),
    )


def date_format_iso(spark, sf):
    at = F.col("ts")
    return _events(spark, sf).select(
        "event_id", dates.yymmdd(at).alias("yymmdd"), dates.iso_date(at).alias("iso_date")
    )


# --- stored tables: joins, aggregates, backfill ---------------------------------------------------

def json_with_zip(spark, sf):
    return backfill.json_with_zip(json_ledger(spark, sf), zip_ledger(spark, sf))


def manifest_counts(spark, sf):
    return backfill.manifest_counts(facts(spark, sf))


def oldest_date(spark, sf):
    return retention.oldest_date(zip_ledger(spark, sf))


def _partly_populated(ledger: DataFrame) -> DataFrame:
    """The ledger with some rows still lacking their summary columns."""
    number = F.regexp_extract("json_file_name", r"m_([0-9]+)", 1).cast("long")
    return ledger.withColumns(
        {
            name: F.when(number % 11 != 0, F.col(name))
            for name in [*schema.VOYAGE_COLUMNS, *schema.COUNT_COLUMNS]
        }
    )


def earliest_unpopulated(spark, sf):
    return backfill.earliest_unpopulated(_partly_populated(json_ledger(spark, sf)), zip_ledger(spark, sf), SINCE)


def backfill_summary(spark, sf):
    """Every dated archive from SINCE on."""
    return backfill.updated_rows(
        _partly_populated(json_ledger(spark, sf)), zip_ledger(spark, sf), facts(spark, sf), since=SINCE
    )


def backfill_one_date(spark, sf):
    ledger, zips = (dated(spark, sf, table, PURGE_DATE) for table in (tables.JSON_LEDGER, tables.ZIP_LEDGER))
    return backfill.updated_rows(_partly_populated(ledger), zips, facts(spark, sf), date=PURGE_DATE)


def created_on_backfill(spark, sf):
    cleared = zip_ledger(spark, sf).withColumn(
        "created_on", F.when(F.col("success"), F.col("created_on"))
    )
    return backfill.with_created_on(cleared)


def duplicate_ledger_rows(spark, sf):
    return quality.duplicate_ledger_rows(json_ledger(spark, sf), zip_ledger(spark, sf))


def duplicate_ledger_rows_for_date(spark, sf):
    ledger, zips = (dated(spark, sf, table, PURGE_DATE) for table in (tables.JSON_LEDGER, tables.ZIP_LEDGER))
    return quality.duplicate_ledger_rows(ledger, zips, PURGE_DATE)


# --- stored tables: retention ---------------------------------------------------------------------

def retention_expired(spark, sf):
    return retention.with_expiry(zip_ledger(spark, sf), instant(AS_OF), RETAINED_YEARS)


def retention_target(spark, sf):
    return retention.retention_target(zip_ledger(spark, sf), instant(AS_OF), RETAINED_YEARS)


def _names(spark, sf, limit) -> DataFrame:
    ledger, zips = (dated(spark, sf, table, PURGE_DATE) for table in (tables.JSON_LEDGER, tables.ZIP_LEDGER))
    return retention.purge_batch(ledger, zips, PURGE_DATE, limit)


def purge_batch(spark, sf):
    return _names(spark, sf, SMALL_BATCH).select("json_file_name")


def purge_remaining_fact(spark, sf):
    return retention.remaining_facts(facts(spark, sf), _names(spark, sf, FULL_BATCH))


def purge_remaining_json(spark, sf):
    return retention.remaining_json(json_ledger(spark, sf), _names(spark, sf, FULL_BATCH))


def purge_remaining_zip(spark, sf):
    return retention.remaining_zips(
        zip_ledger(spark, sf), _names(spark, sf, FULL_BATCH), PURGE_DATE, FULL_BATCH
    )


def _purge_counts(spark, sf, limit) -> DataFrame:
    return retention.purge_counts(
        facts(spark, sf), json_ledger(spark, sf), zip_ledger(spark, sf),
        _names(spark, sf, limit), PURGE_DATE, limit,
    )


def purge_counts(spark, sf):
    return _purge_counts(spark, sf, FULL_BATCH)


def purge_counts_partial(spark, sf):
    return _purge_counts(spark, sf, SMALL_BATCH)


def delete_fact_by_json(spark, sf):
    return retention.without_key(facts(spark, sf), "json_file", DELETED_JSON)


def delete_json_by_name(spark, sf):
    return retention.without_key(json_ledger(spark, sf), "json_file_name", DELETED_JSON)


def delete_zip_by_name(spark, sf):
    return retention.without_key(zip_ledger(spark, sf), "zip_file_name", DELETED_ZIP)


# --- stored tables: monitoring and look-ups -------------------------------------------------------

def pipeline_freshness(spark, sf):
    return quality.freshness(zip_ledger(spark, sf), instant(AS_OF), FRESHNESS_SECONDS)


def arrival_lookup(spark, sf):
    return quality.arrivals(json_ledger(spark, sf), **ARRIVAL)


def route_week_lookup(spark, sf):
    return quality.route_week(facts(spark, sf), **ROUTE)


def route_week_day_lookup(spark, sf):
    return quality.route_week(facts(spark, sf), **ROUTE, day=ROUTE_DAY)


def arrival_week_lookup(spark, sf):
    return quality.arrivals_in_week(json_ledger(spark, sf), **VOYAGE_WEEK)


def route_week_year_lookup(spark, sf):
    return quality.route_documents(json_ledger(spark, sf), **ROUTE_WEEK)


def document_age_lookup(spark, sf):
    return quality.document_age(facts(spark, sf), **DOCUMENT)


# --- streaming ------------------------------------------------------------------------------------

def stream_ingest(spark, sf):
    """The JSON ledger after the archives went through the stream, in several batches."""
    return archives.streamed(spark, sf).read(tables.JSON_LEDGER)


def stream_replay(spark, sf):
    """Rows per table after every archive came a second time."""
    store = archives.streamed(spark, sf, times=2)
    counted = [
        store.read(table).agg(F.count("*").alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")
        for table in (tables.PASSENGER_FACT, tables.JSON_LEDGER, tables.ZIP_LEDGER)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def stream_freshness(spark, sf):
    """Per threshold, whether the stream is healthy by its looks, of which the last found nothing, and by what it processed."""
    store = archives.quiet_stream(spark, sf)
    looks = quality.freshness(store.checks(), instant(AS_OF), FRESHNESS_SECONDS)
    work = quality.freshness(store.read(tables.ZIP_LEDGER), instant(AS_OF), FRESHNESS_SECONDS)
    return looks.select("threshold_seconds", F.col("last_processed_at").alias("last_looked_at"), F.col("healthy").alias("healthy_by_looks")).join(
        work.select("threshold_seconds", "last_processed_at", F.col("healthy").alias("healthy_by_work")), "threshold_seconds"
    )


_SQL_KEYS = {"json_ledger": json_ledger_rows, "zip_ledger": zip_ledger_rows}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        list_after_marker, next_marker, bootstrap_marker, last_persisted_file,
        list_files, zip_scan, parse_manifest, ingest_batch, passenger_fact, interactive_passengers,
        non_interactive_passengers, best_passengers, has_interactive, ingest_counts, classify_outcome,
        quarantine_json, suspicious_date, schema_limit_violations, zip_totals, run_metrics,
        first_occurrence, unprocessed_entries, json_has_been_processed, ledger_after_batch, created_on,
        scheduled_ts, voyage_number, age_or_default, dow_week, date_parts, date_shift, epoch_millis,
        date_format_iso, json_with_zip, manifest_counts, oldest_date, earliest_unpopulated,
        backfill_summary, backfill_one_date, created_on_backfill, duplicate_ledger_rows,
        duplicate_ledger_rows_for_date, retention_expired, retention_target, purge_batch,
        purge_remaining_fact, purge_remaining_json, purge_remaining_zip, purge_counts,
        purge_counts_partial, delete_fact_by_json, delete_json_by_name, delete_zip_by_name,
        pipeline_freshness, arrival_lookup, route_week_lookup, route_week_day_lookup,
        arrival_week_lookup, route_week_year_lookup, document_age_lookup, stream_ingest, stream_replay,
        stream_freshness,
    ]
    return {function.__name__: function for function in named} | _SQL_KEYS
