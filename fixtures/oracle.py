"""The same results in SQL, straight from the relational tables and without any JSON text."""

from __future__ import annotations

from fixtures.queries import (
    ARRIVAL,
    DELETED_JSON,
    DELETED_ZIP,
    DOCUMENT,
    FRESHNESS_SECONDS,
    FULL_BATCH,
    MARKER,
    PURGE_DATE,
    RETAINED_YEARS,
    ROUTE,
    ROUTE_DAY,
    ROUTE_WEEK,
    SINCE,
    SMALL_BATCH,
    VOYAGE_WEEK,
)
from fixtures.views import AS_OF, BATCH_AT, LINES_PER_DOCUMENT, ORDERS_PER_BLOCK, PRIOR_AT

_DATED = r"drt_dq_[0-9]{6}_[0-9]{6}_[0-9]{4}\.zip"


def _created_on(name: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({name}, '{_DATED}') THEN '20' || substr({name}, 8, 2) || '-' || "
        f"substr({name}, 10, 2) || '-' || substr({name}, 12, 2) END"
    )


def _derived(lines_per_document: int) -> str:
    return rf"""
WITH lines AS (
  SELECT l.l_orderkey AS k,
         l.l_partkey % CAST(ceil(count(*) OVER (PARTITION BY l.l_orderkey) / {lines_per_document}.0) AS BIGINT) AS part,
         CAST(ceil(count(*) OVER (PARTITION BY l.l_orderkey) / {lines_per_document}.0) AS BIGINT) AS parts,
         CASE WHEN l_linenumber % 3 = 0 THEN 'P' WHEN l_linenumber % 3 = 1 THEN 'I' END AS document_type,
         'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS country,
         CASE WHEN s_nationkey < 10 THEN 'Y' ELSE '' END AS eea_flag,
         CASE WHEN l_linenumber = 5 THEN 'unknown' WHEN l_linenumber = 6 THEN NULL
              WHEN l_linenumber = 4 AND l.l_orderkey % 41 = 0 THEN '99999'
              ELSE CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) END AS age_text,
         CASE WHEN l_linestatus = 'O' THEN 'Y' WHEN l_linenumber = 7 THEN 'XY' ELSE 'N' END AS transit_flag,
         CASE WHEN l_returnflag = 'A' THEN 'P' || CAST(l_partkey AS VARCHAR) WHEN l_returnflag = 'R' THEN '' END AS ident
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey
), pax AS (
  SELECT *, coalesce(ident, '') <> '' AS named, coalesce(try_cast(age_text AS INTEGER), -1) AS age,
         contains(transit_flag, 'Y') AS mentions,
         bool_or(coalesce(ident, '') <> '') OVER (PARTITION BY k, part) AS any_named
  FROM lines
), best AS (
  SELECT * FROM pax WHERE named OR NOT any_named
), lists AS (
  SELECT k, part, count(*) AS n, bool_or(named) AS any_named,
         count(*) FILTER (WHERE NOT named) AS ni, count(*) FILTER (WHERE NOT named AND mentions) AS nit,
         count(*) FILTER (WHERE named) AS i, count(*) FILTER (WHERE named AND mentions) AS it
  FROM pax GROUP BY k, part
), best_lists AS (
  SELECT k, part, count(*) AS n_best, bool_or(age > 32767) AS bad_age FROM best GROUP BY k, part
), voyages AS (
  SELECT o_orderkey AS k, unnest(range(0, coalesce(p.parts, 1))) AS part,
         CASE WHEN o_orderstatus = 'O' THEN 'CI' ELSE 'DC' END AS event_code,
         ['LHR', 'STN', 'MAN', 'EDI', 'LGW'][1 + o_custkey % 5] AS arrival_port_code,
         'P' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS departure_port_code,
         CASE WHEN o_orderkey % 23 = 0 THEN '12A' ELSE lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS voyage_text,
         CASE WHEN o_orderkey % 37 = 0 THEN 'CARR' || CAST(o_orderkey % 7 AS VARCHAR) || 'X'
              ELSE 'C' || CAST(o_orderkey % 7 AS VARCHAR) END AS carrier_code,
         CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) AS arrival,
         CASE WHEN o_orderkey % 2 = 0 THEN '06:00' ELSE '07:30:00' END AS time_text
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT k AS lk, any_value(parts) AS parts FROM lines GROUP BY k) p ON lk = o_orderkey
), docs AS (
  SELECT v.*, v.arrival - CAST(v.k % 5 AS INTEGER) AS zip_date,
         lpad(CAST((v.k // {ORDERS_PER_BLOCK} + v.part) % 1000000 AS VARCHAR), 6, '0') AS block,
         (v.k // {ORDERS_PER_BLOCK} + v.part) // 1000000 AS round_no,
         'm_' || CAST(v.k AS VARCHAR) || CASE WHEN v.part > 0 THEN '_' || CAST(v.part AS VARCHAR) ELSE '' END || '.json' AS json_file_name,
         v.part * 4294967296 + 2 * v.k AS idx,
         v.k % 17 <> 0 AS parse_ok,
         CASE WHEN v.k % 19 <> 0 THEN CAST(v.arrival AS TIMESTAMP)
              + CASE WHEN v.k % 2 = 0 THEN INTERVAL 360 MINUTE ELSE INTERVAL 450 MINUTE END END AS scheduled_at,
         try_cast(CASE WHEN v.k % 23 <> 0 THEN v.voyage_text END AS INTEGER) AS voyage_number,
         coalesce(n, 0) AS n, coalesce(l.any_named, false) AS any_named,
         coalesce(ni, 0) AS ni, coalesce(nit, 0) AS nit, coalesce(i, 0) AS i, coalesce(it, 0) AS it,
         coalesce(n_best, 0) AS n_best, coalesce(bad_age, false) AS bad_age
  FROM voyages v LEFT JOIN lists l ON v.k = l.k AND v.part = l.part
  LEFT JOIN best_lists b ON v.k = b.k AND v.part = b.part
), judged AS (
  SELECT *,
         parse_ok AND n_best > 0 AND (k % 37 = 0 OR bad_age) AS fact_limits_broken,
         parse_ok AND k % 37 = 0 AS ledger_limits_broken,
         CASE WHEN NOT parse_ok THEN 'bad_json' WHEN scheduled_at IS NULL THEN 'bad_schedule'
              WHEN (voyage_number IS NULL AND n_best > 0) OR k % 37 = 0 OR (n_best > 0 AND bad_age) THEN 'bad_row'
              ELSE 'ok' END AS verdict,
         CASE WHEN k % 31 = 0 THEN 'legacy_' || block || '_' || CAST(7 * round_no + k % 7 AS VARCHAR) || '.zip'
              ELSE 'drt_dq_' || strftime(zip_date, '%y%m%d') || '_' || block || '_' || lpad(CAST(3 * round_no + k % 2 AS VARCHAR), 4, '0') || '.zip' END AS zip1,
         'drt_dq_' || strftime(zip_date + 1, '%y%m%d') || '_' || block || '_' || lpad(CAST(3 * round_no + 2 AS VARCHAR), 4, '0') || '.zip' AS zip2
  FROM docs
), entries AS (
  SELECT *, zip1 AS zip_file_name, idx AS entry_index, false AS repeated, k % 3 = 0 AS prior FROM judged
  UNION ALL
  SELECT *, zip1, idx + 1, true, false FROM judged WHERE k % 13 = 0
  UNION ALL
  SELECT *, zip2, idx, false, false FROM judged WHERE k % 29 = 0
), classed AS (
  SELECT *, CASE WHEN repeated THEN 'already_processed' ELSE verdict END AS outcome,
         {_created_on('zip_file_name')} AS created_on,
         bool_or(prior) OVER (PARTITION BY zip_file_name, json_file_name) AS recorded
  FROM entries
), flagged AS (
  SELECT *, coalesce(scheduled_at - CAST(created_on AS TIMESTAMP) > INTERVAL 48 HOUR, false) AS late FROM classed
), archives AS (
  SELECT DISTINCT zip_file_name, true AS zip_ok FROM entries
  UNION ALL SELECT 'drt_dq_260101_00000' || CAST(r_regionkey AS VARCHAR) || '_0000.zip', true FROM region
  UNION ALL SELECT 'drt_dq_2602' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '_000000_0009.zip', false FROM nation
), new_rows AS (
  SELECT * FROM flagged WHERE outcome <> 'already_processed'
), good AS (
  SELECT * FROM flagged WHERE outcome = 'ok'
), facts AS (
  SELECT event_code, arrival_port_code, departure_port_code, voyage_number, carrier_code,
         scheduled_at AS scheduled_date, CAST(dayofweek(scheduled_at) AS INTEGER) AS day_of_week,
         CAST(weekofyear(scheduled_at) AS INTEGER) AS week_of_year,
         coalesce(document_type, '') AS document_type, country AS document_issuing_country_code, eea_flag,
         age, 'LHR' AS disembarkation_port_code, transit_flag AS in_transit_flag,
         'GBR' AS disembarkation_port_country_code, country AS nationality_country_code,
         coalesce(ident, '') AS passenger_identifier, transit_flag = 'Y' AS in_transit, json_file_name AS json_file
  FROM good JOIN best ON good.k = best.k AND good.part = best.part
), ledger AS (
  SELECT zip_file_name, json_file_name, outcome = 'ok' AND late AS suspicious_date, outcome = 'ok' AS success,
         recorded,
         CASE WHEN outcome = 'ok' THEN arrival_port_code END AS arrival_port_code,
         CASE WHEN outcome = 'ok' THEN departure_port_code END AS departure_port_code,
         CASE WHEN outcome = 'ok' THEN voyage_number END AS voyage_number,
         CASE WHEN outcome = 'ok' THEN carrier_code END AS carrier_code,
         CASE WHEN outcome = 'ok' THEN scheduled_at END AS scheduled,
         CASE WHEN outcome = 'ok' THEN event_code END AS event_code,
         CASE WHEN outcome = 'ok' THEN CAST(ni AS INTEGER) END AS non_interactive_total_count,
         CASE WHEN outcome = 'ok' THEN CAST(nit AS INTEGER) END AS non_interactive_trans_count,
         CASE WHEN outcome = 'ok' THEN CAST(i AS INTEGER) END AS interactive_total_count,
         CASE WHEN outcome = 'ok' THEN CAST(it AS INTEGER) END AS interactive_trans_count
  FROM new_rows
), stored_json AS (
  SELECT * EXCLUDE (recorded),
         CASE WHEN recorded THEN TIMESTAMP '{PRIOR_AT}' ELSE TIMESTAMP '{BATCH_AT}' END AS processed_at
  FROM ledger
), stored_zip AS (
  SELECT zip_file_name, bool_or(verdict = 'ok') AS success, TIMESTAMP '{PRIOR_AT}' AS processed_at,
         any_value(created_on) AS created_on
  FROM flagged WHERE prior GROUP BY zip_file_name
  UNION ALL
  SELECT a.zip_file_name, coalesce(bool_or(outcome = 'ok' AND NOT recorded), false), TIMESTAMP '{BATCH_AT}',
         {_created_on('a.zip_file_name')}
  FROM archives a LEFT JOIN new_rows e ON a.zip_file_name = e.zip_file_name GROUP BY a.zip_file_name
), counted AS (
  SELECT json_file, arrival_port_code, departure_port_code, voyage_number, carrier_code,
         scheduled_date AS scheduled, event_code,
         count(*) FILTER (WHERE passenger_identifier = '') AS non_interactive_total_count,
         count(*) FILTER (WHERE passenger_identifier = '' AND in_transit) AS non_interactive_trans_count,
         count(*) FILTER (WHERE passenger_identifier <> '') AS interactive_total_count,
         count(*) FILTER (WHERE passenger_identifier <> '' AND in_transit) AS interactive_trans_count
  FROM facts GROUP BY ALL
), unfilled AS (
  SELECT *, CAST(regexp_extract(json_file_name, 'm_([0-9]+)', 1) AS BIGINT) % 11 = 0 AS waiting FROM stored_json
), named_json AS (
  SELECT j.json_file_name FROM stored_json j JOIN stored_zip z ON j.zip_file_name = z.zip_file_name
  WHERE z.created_on = '{PURGE_DATE}'
), parsed AS (
  SELECT * FROM flagged WHERE parse_ok
)
"""


_ENTRY = "e.zip_file_name, e.entry_index, e.json_file_name"
_LEDGER_COLUMNS = (
    "zip_file_name, json_file_name, suspicious_date, success, processed_at, arrival_port_code, "
    "departure_port_code, voyage_number, carrier_code, scheduled, event_code, non_interactive_total_count, "
    "non_interactive_trans_count, interactive_total_count, interactive_trans_count"
)
_TOTALS = """
SELECT a.zip_file_name, any_value(a.zip_ok) AS zip_ok,
       count(*) FILTER (WHERE {new}) AS total,
       count(*) FILTER (WHERE {new} AND outcome = 'ok') AS successful,
       coalesce(sum(n_best) FILTER (WHERE {new} AND outcome = 'ok'), 0)::BIGINT AS fact_rows,
       count(*) FILTER (WHERE {new} AND outcome = 'ok' AND late) AS suspicious{more}
FROM archives a LEFT JOIN flagged e ON a.zip_file_name = e.zip_file_name GROUP BY a.zip_file_name
"""


def _passengers(where: str) -> str:
    return (
        f"SELECT {_ENTRY}, ident AS passenger_identifier, document_type, transit_flag AS in_transit_flag "
        f"FROM parsed e JOIN pax ON e.k = pax.k AND e.part = pax.part WHERE {where}"
    )


def _names(limit: int) -> str:
    return f"SELECT json_file_name FROM named_json ORDER BY json_file_name LIMIT {limit}"


def _purge_counts(limit: int) -> str:
    return f"""
SELECT (SELECT count(*) FROM facts WHERE json_file IN ({_names(limit)})) AS deleted_manifests,
       (SELECT count(*) FROM stored_json WHERE json_file_name IN ({_names(limit)})) AS deleted_jsons,
       CASE WHEN (SELECT count(*) FROM ({_names(limit)})) < {limit}
            THEN (SELECT count(*) FROM stored_zip WHERE created_on = '{PURGE_DATE}') ELSE 0 END AS deleted_zips
"""


def _updated(condition: str) -> str:
    """The literal form: per ledger row, the first group of its join with the facts."""
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE {test}) AS INTEGER) AS {name}"
        for name, test in {
            "non_interactive_total_count": "f.passenger_identifier = ''",
            "non_interactive_trans_count": "f.passenger_identifier = '' AND f.in_transit",
            "interactive_total_count": "f.passenger_identifier <> ''",
            "interactive_trans_count": "f.passenger_identifier <> '' AND f.in_transit",
        }.items()
    )
    return f"""
, groups AS (
  SELECT j.zip_file_name, j.json_file_name, f.arrival_port_code, f.departure_port_code, f.voyage_number,
         f.carrier_code, f.scheduled_date AS scheduled, f.event_code, {counts}
  FROM stored_json j LEFT JOIN facts f ON j.json_file_name = f.json_file GROUP BY ALL
), picked AS (
  SELECT * FROM groups QUALIFY row_number() OVER (PARTITION BY zip_file_name, json_file_name
    ORDER BY arrival_port_code NULLS LAST, departure_port_code NULLS LAST, voyage_number NULLS LAST,
             carrier_code NULLS LAST, scheduled NULLS LAST, event_code NULLS LAST) = 1
)
SELECT j.zip_file_name, j.json_file_name, j.suspicious_date, j.success, j.processed_at,
       p.* EXCLUDE (zip_file_name, json_file_name)
FROM stored_json j JOIN picked p ON j.zip_file_name = p.zip_file_name AND j.json_file_name = p.json_file_name
WHERE j.zip_file_name IN (SELECT zip_file_name FROM stored_zip WHERE {condition})
"""


def _duplicates(condition: str) -> str:
    key = "json_file_name, arrival_port_code, departure_port_code, voyage_number, carrier_code, scheduled, event_code"
    return (
        f"SELECT {key}, count(*) AS dupes FROM stored_json j JOIN stored_zip z "
        f"ON j.zip_file_name = z.zip_file_name WHERE {condition} GROUP BY {key} HAVING count(*) > 1"
    )


def _streamed_counts() -> str:
    return """
SELECT 'passenger_fact' AS table_name, count(*) AS row_count FROM facts
UNION ALL SELECT 'json_ledger', count(*) FROM ledger
UNION ALL SELECT 'zip_ledger', 2 * count(*) FROM archives
"""


def oracle_sql(lines_per_document: int = LINES_PER_DOCUMENT) -> dict[str, str]:
    years_ago = f"TIMESTAMP '{AS_OF}' - INTERVAL {365 * RETAINED_YEARS} DAY"
    fresh_ledger = f"SELECT {_LEDGER_COLUMNS} FROM (SELECT *, TIMESTAMP '{BATCH_AT}' AS processed_at FROM ledger)"
    by_position = "'20' || substr(zip_file_name, 8, 2) || '-' || substr(zip_file_name, 10, 2) || '-' || substr(zip_file_name, 12, 2)"
    route = (
        f"event_code = '{ROUTE['event_code']}' AND arrival_port_code = '{ROUTE['arrival']}' "
        f"AND departure_port_code = '{ROUTE['departure']}' AND week_of_year = {ROUTE['week']}"
    )
    bodies = {
        "list_files": f"SELECT zip_file_name FROM archives WHERE zip_file_name > '{MARKER}'",
        "list_after_marker": f"SELECT zip_file_name FROM archives WHERE zip_file_name > '{MARKER}' ORDER BY 1",
        "next_marker": f"SELECT coalesce(max(zip_file_name), '{MARKER}') AS next_marker FROM archives WHERE NOT contains(zip_file_name, '{MARKER}')",
        "bootstrap_marker": "SELECT max(zip_file_name) AS marker FROM stored_zip",
        "last_persisted_file": "SELECT max(zip_file_name) AS last_file FROM stored_zip",
        "zip_scan": """SELECT zip_file_name, zip_ok, CAST(NULL AS BIGINT) AS entry_index, CAST(NULL AS VARCHAR) AS json_file_name,
            CAST(NULL AS BIGINT) AS occurrence, CAST(NULL AS VARCHAR) AS event_code FROM archives
            UNION ALL SELECT zip_file_name, true,
            row_number() OVER (PARTITION BY zip_file_name ORDER BY entry_index) - 1, json_file_name,
            row_number() OVER (PARTITION BY zip_file_name, json_file_name ORDER BY entry_index),
            CASE WHEN parse_ok THEN CASE WHEN repeated THEN 'XX' ELSE event_code END END FROM flagged""",
        "parse_manifest": f"""SELECT {_ENTRY}, parse_ok,
            CASE WHEN parse_ok THEN CASE WHEN repeated THEN 'XX' ELSE event_code END END AS event_code,
            CASE WHEN parse_ok THEN arrival_port_code END AS arrival_port_code,
            CASE WHEN parse_ok THEN departure_port_code END AS departure_port_code,
            CASE WHEN parse_ok THEN voyage_text END AS voyage_number_text,
            CASE WHEN parse_ok THEN carrier_code END AS carrier_code,
            CASE WHEN parse_ok THEN CASE WHEN k % 19 = 0 THEN '2022x06x01' ELSE strftime(arrival, '%Y-%m-%d') END END AS date_text,
            CASE WHEN parse_ok THEN time_text END AS time_text,
            CASE WHEN parse_ok THEN CAST(n AS INTEGER) END AS passengers FROM flagged e""",
        "ingest_batch": _TOTALS.format(
            new="NOT repeated AND NOT recorded",
            more=", count(*) FILTER (WHERE NOT repeated AND NOT recorded AND outcome = 'ok') > 0 AS success, "
            + _created_on("a.zip_file_name") + " AS created_on",
        ),
        "passenger_fact": "SELECT * FROM facts",
        "json_ledger": fresh_ledger,
        "zip_ledger": f"SELECT zip_file_name, successful > 0 AS success, TIMESTAMP '{BATCH_AT}' AS processed_at, "
        f"{_created_on('zip_file_name')} AS created_on FROM ({_TOTALS.format(new='NOT repeated', more='')})",
        "interactive_passengers": _passengers("named"),
        "non_interactive_passengers": _passengers("NOT named"),
        "best_passengers": _passengers("named OR NOT pax.any_named"),
        "has_interactive": f"SELECT {_ENTRY}, CASE WHEN parse_ok THEN any_named END AS has_interactive FROM flagged e",
        "ingest_counts": f"""SELECT {_ENTRY}, CAST(ni AS INTEGER) AS non_interactive_total_count,
            CAST(nit AS INTEGER) AS non_interactive_trans_count, CAST(i AS INTEGER) AS interactive_total_count,
            CAST(it AS INTEGER) AS interactive_trans_count FROM good e""",
        "classify_outcome": f"SELECT {_ENTRY}, outcome FROM flagged e",
        "quarantine_json": f"SELECT * FROM ({fresh_ledger}) WHERE NOT success",
        "suspicious_date": f"SELECT {_ENTRY}, late AS suspicious_date FROM good e",
        "schema_limit_violations": f"SELECT {_ENTRY}, fact_limits_broken, ledger_limits_broken FROM flagged e",
        "zip_totals": _TOTALS.format(new="NOT repeated", more=""),
        "run_metrics": f"""SELECT CAST(sum(successful) AS BIGINT) AS manifests_processed,
            count(*) FILTER (WHERE NOT zip_ok) AS zip_failures, count(*) AS zips_processed
            FROM ({_TOTALS.format(new="NOT repeated", more="")})""",
        "first_occurrence": "SELECT zip_file_name, json_file_name, min(entry_index) AS entry_index FROM entries GROUP BY ALL",
        "unprocessed_entries": f"SELECT {_ENTRY} FROM flagged e WHERE NOT recorded",
        "json_has_been_processed": f"SELECT {_ENTRY}, recorded AS processed FROM flagged e",
        "ledger_after_batch": f"SELECT {_LEDGER_COLUMNS} FROM stored_json",
        "created_on": f"SELECT zip_file_name, {_created_on('zip_file_name')} AS created_on FROM archives",
        "scheduled_ts": f"SELECT {_ENTRY}, CASE WHEN parse_ok THEN scheduled_at END AS scheduled FROM flagged e",
        "voyage_number": f"SELECT {_ENTRY}, CASE WHEN parse_ok THEN voyage_number END AS voyage_number FROM flagged e",
        "age_or_default": f"SELECT {_ENTRY}, age_text, age FROM parsed e JOIN pax ON e.k = pax.k AND e.part = pax.part",
        "json_with_zip": "SELECT j.*, z.success AS zip_success, z.created_on FROM stored_json j JOIN stored_zip z ON j.zip_file_name = z.zip_file_name",
        "manifest_counts": "SELECT * FROM counted",
        "oldest_date": "SELECT min(created_on) AS oldest_date FROM stored_zip",
        "earliest_unpopulated": f"""SELECT min(z.created_on) AS earliest_date FROM unfilled j JOIN stored_zip z
            ON j.zip_file_name = z.zip_file_name
            WHERE waiting AND j.success AND z.success AND z.created_on >= '{SINCE}'""",
        "backfill_summary": _updated(f"created_on >= '{SINCE}'"),
        "backfill_one_date": _updated(f"created_on = '{PURGE_DATE}'"),
        "created_on_backfill": f"""SELECT zip_file_name, success, processed_at,
            coalesce(CASE WHEN success THEN created_on END, CAST(try_cast({by_position} AS DATE) AS VARCHAR)) AS created_on
            FROM stored_zip""",
        "duplicate_ledger_rows": _duplicates("true"),
        "duplicate_ledger_rows_for_date": _duplicates(f"z.created_on = '{PURGE_DATE}'"),
        "retention_expired": f"SELECT *, coalesce(CAST(created_on AS TIMESTAMP) < {years_ago}, false) AS expired FROM stored_zip",
        "retention_target": f"""SELECT min(created_on) AS oldest_date,
            CASE WHEN CAST(min(created_on) AS TIMESTAMP) < {years_ago} THEN min(created_on) END AS purge_date FROM stored_zip""",
        "purge_batch": _names(SMALL_BATCH),
        "purge_remaining_fact": f"SELECT * FROM facts WHERE json_file NOT IN ({_names(FULL_BATCH)})",
        "purge_remaining_json": f"SELECT {_LEDGER_COLUMNS} FROM stored_json WHERE json_file_name NOT IN ({_names(FULL_BATCH)})",
        "purge_remaining_zip": f"""SELECT * FROM stored_zip WHERE coalesce(created_on, '') <> '{PURGE_DATE}'
            OR (SELECT count(*) FROM ({_names(FULL_BATCH)})) >= {FULL_BATCH}""",
        "purge_counts": _purge_counts(FULL_BATCH),
        "purge_counts_partial": _purge_counts(SMALL_BATCH),
        "delete_fact_by_json": f"SELECT * FROM facts WHERE json_file <> '{DELETED_JSON}'",
        "delete_json_by_name": f"SELECT {_LEDGER_COLUMNS} FROM stored_json WHERE json_file_name <> '{DELETED_JSON}'",
        "delete_zip_by_name": f"SELECT * FROM stored_zip WHERE zip_file_name <> '{DELETED_ZIP}'",
        "pipeline_freshness": " UNION ALL ".join(
            f"SELECT max(processed_at) AS last_processed_at, CAST({seconds} AS BIGINT) AS threshold_seconds, "
            f"TIMESTAMP '{AS_OF}' - max(processed_at) <= INTERVAL {seconds} SECOND AS healthy FROM stored_zip"
            for seconds in FRESHNESS_SECONDS
        ),
        "arrival_lookup": f"""SELECT {_LEDGER_COLUMNS}, CAST(scheduled AS DATE) AS scheduled_on,
            CAST(dayofweek(scheduled) AS INTEGER) AS day_of_week, CAST(weekofyear(scheduled) AS INTEGER) AS week,
            CAST(year(scheduled) AS INTEGER) AS year FROM stored_json
            WHERE arrival_port_code = '{ARRIVAL['port']}' AND CAST(scheduled AS DATE) = DATE '{ARRIVAL['date']}'
            AND event_code = '{ARRIVAL['event_code']}'""",
        "route_week_lookup": f"SELECT * FROM facts WHERE {route}",
        "route_week_day_lookup": f"SELECT * FROM facts WHERE {route} AND day_of_week = {ROUTE_DAY}",
        "arrival_week_lookup": f"""SELECT {_LEDGER_COLUMNS} FROM stored_json WHERE arrival_port_code = '{VOYAGE_WEEK['port']}'
            AND event_code = '{VOYAGE_WEEK['event_code']}' AND voyage_number = {VOYAGE_WEEK['voyage_number']}
            AND weekofyear(scheduled) = {VOYAGE_WEEK['week']} AND year(scheduled) = {VOYAGE_WEEK['year']}""",
        "route_week_year_lookup": f"""SELECT {_LEDGER_COLUMNS} FROM stored_json WHERE event_code = '{ROUTE_WEEK['event_code']}'
            AND arrival_port_code = '{ROUTE_WEEK['arrival']}' AND departure_port_code = '{ROUTE_WEEK['departure']}'
            AND weekofyear(scheduled) = {ROUTE_WEEK['week']} AND year(scheduled) = {ROUTE_WEEK['year']}""",
        "document_age_lookup": f"""SELECT * FROM facts WHERE event_code = '{DOCUMENT['event_code']}'
            AND arrival_port_code = '{DOCUMENT['arrival']}' AND document_type = '{DOCUMENT['document_type']}'
            AND nationality_country_code = '{DOCUMENT['nationality']}' AND age >= {DOCUMENT['min_age']}""",
        "stream_ingest": fresh_ledger,
        "stream_replay": _streamed_counts(),
        "stream_freshness": " UNION ALL ".join(
            f"SELECT CAST({seconds} AS BIGINT) AS threshold_seconds, TIMESTAMP '{AS_OF}' AS last_looked_at, count(*) > 0 AS healthy_by_looks, "
            f"TIMESTAMP '{BATCH_AT}' AS last_processed_at, TIMESTAMP '{AS_OF}' - TIMESTAMP '{BATCH_AT}' <= INTERVAL {seconds} SECOND AS healthy_by_work FROM archives"
            for seconds in FRESHNESS_SECONDS
        ),
    }
    derived = _derived(lines_per_document)
    plain = {
        "dow_week": """SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS day_of_week,
            CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year FROM orders""",
        "date_parts": """SELECT event_id, CAST(isodow(ts) AS INTEGER) AS iso_day_of_week,
            CAST(year(ts) AS INTEGER) AS full_year, CAST(month(ts) AS INTEGER) AS month,
            CAST(day(ts) AS INTEGER) AS day, CAST(minute(ts) AS INTEGER) AS minute FROM events""",
        "date_shift": "SELECT event_id, ts + INTERVAL 36 HOUR AS later, ts - INTERVAL 90 SECOND AS earlier FROM events",
        "epoch_millis": """SELECT event_id, epoch_us(ts) // 1000 AS millis,
            make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_millis FROM events""",
        "date_format_iso": "SELECT event_id, strftime(ts, '%y%m%d') AS yymmdd, strftime(ts, '%Y-%m-%d') AS iso_date FROM events",
    }
    return {key: derived + body for key, body in bodies.items()} | plain
