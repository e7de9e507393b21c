from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from landfall.operators import classify, dedupe, rows
from landfall.plans.ingest import RunMetrics, classified, ingest_new_files, run_batch
from landfall.session import fresh_path
from landfall.sources.archives import archive_rows
from landfall.sources.tables import JSON_LEDGER, PASSENGER_FACT, ZIP_LEDGER, Store
from samples import archive, at, files, json_rows, manifest, passenger, rows_of

NAME = "some.zip"
DATED = "drt_dq_220601_120000_0001.zip"
GOOD, BAD_JSON = manifest(), "{}"
BAD_DATE = manifest(date="2022x06x01", time="10x00")


@pytest.fixture
def store(spark):
    return Store(spark, fresh_path(spark, "test-store"))


def ingest(store, archives: dict[str, bytes], batch_id=0, when="2022-06-01 12:00:00") -> RunMetrics:
    frame = files(store.spark, archives)
    return run_batch(store, archive_rows(frame), frame, batch_id, at(when))


def ledger(store):
    found = store.read(JSON_LEDGER).orderBy("zip_file_name", "json_file_name").collect()
    return [(r.zip_file_name, r.json_file_name, r.success) for r in found]


def zips(store):
    found = store.read(ZIP_LEDGER).orderBy("zip_file_name", "processed_at").collect()
    return [(r.zip_file_name, r.success) for r in found]


def facts(store):
    return sorted(r.json_file for r in store.read(PASSENGER_FACT).collect())


def totals(spark, entries, recorded=()):
    known = spark.createDataFrame(list(recorded), "zip_file_name string, json_file_name string")
    row = rows.zip_totals(classified(rows_of(spark, {NAME: entries}), known)).first()
    return row.total, row.successful


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([], (0, 0)),
        ([("m.json", BAD_JSON)], (1, 0)),
        ([("m.json", GOOD)], (1, 1)),
        ([("m.json", BAD_DATE)], (1, 0)),
        ([("1.json", GOOD), ("2.json", GOOD), ("3.json", GOOD)], (3, 3)),
        ([("1.json", GOOD), ("2.json", "broken"), ("3.json", GOOD)], (3, 2)),
        ([("1.json", GOOD), ("1.json", GOOD)], (1, 1)),
        ([("1.json", BAD_JSON), ("1.json", GOOD)], (1, 0)),
    ],
)
def test_totals_of_an_archive(spark, entries, expected):
    assert totals(spark, entries) == expected


def test_recorded_documents_do_not_count(spark):
    entries = [("2.json", GOOD), ("3.json", GOOD)]
    assert totals(spark, entries, [(NAME, "1.json"), (NAME, "2.json")]) == (1, 1)
    assert totals(spark, entries, [("other.zip", "2.json")]) == (2, 2)


def test_failed_archive_is_recorded(store):
    assert ingest(store, {NAME: b"PK\x03\x04torn"}) == RunMetrics(0, 1, 1)
    assert (zips(store), ledger(store), facts(store)) == ([(NAME, False)], [], [])


def test_failed_document_is_recorded_without_values(store):
    assert ingest(store, {NAME: archive([("m.json", BAD_JSON)])}) == RunMetrics(0, 0, 1)
    row = store.read(JSON_LEDGER).first().asDict()
    assert (row.pop("zip_file_name"), row.pop("json_file_name")) == (NAME, "m.json")
    assert (row.pop("success"), row.pop("suspicious_date")) == (False, False)
    assert row.pop("processed_at") is not None
    assert set(row.values()) == {None}
    assert zips(store) == [(NAME, False)]


def test_good_document(store):
    people = [passenger("1", InTransitFlag="XY"), passenger("2", Age="old", InTransitFlag="Y"), passenger("")]
    content = {DATED: archive([("m.json", manifest(people, date="2022-06-04", VoyageNumber="0123"))])}
    assert ingest(store, content) == RunMetrics(1, 0, 1)
    row = store.read(JSON_LEDGER).first()
    assert (row.success, row.suspicious_date, row.voyage_number) == (True, True, 123)
    assert str(row.scheduled) == "2022-06-04 10:00:00"
    assert (row.non_interactive_total_count, row.non_interactive_trans_count) == (1, 0)
    assert (row.interactive_total_count, row.interactive_trans_count) == (2, 2)
    stored = store.read(PASSENGER_FACT).orderBy("passenger_identifier").collect()
    assert [(f.passenger_identifier, f.age, f.in_transit) for f in stored] == [("1", 22, False), ("2", -1, True)]
    assert {(f.day_of_week, f.week_of_year, f.voyage_number, f.json_file) for f in stored} == {(6, 22, 123, "m.json")}
    zip_row = store.read(ZIP_LEDGER).first()
    assert (zip_row.success, zip_row.created_on) == (True, "2022-06-01")


def test_defaults_of_missing_values(store):
    bare = {key: ... for key in (
        "DocumentType", "Age", "DisembarkationPortCode", "DisembarkationPortCountryCode", "NationalityCountryCode",
    )}
    ingest(store, {NAME: archive([("m.json", manifest([passenger(**bare)]))])})
    f = store.read(PASSENGER_FACT).first()
    assert (f.document_type, f.age, f.disembarkation_port_code) == ("", -1, "")
    assert (f.disembarkation_port_country_code, f.nationality_country_code, f.passenger_identifier) == ("", "", "")


def test_document_is_ingested_once_per_archive(store):
    assert ingest(store, {NAME: archive([("1.json", GOOD), ("2.json", GOOD)])}, 0) == RunMetrics(2, 0, 1)
    assert ingest(store, {NAME: archive([("2.json", GOOD), ("3.json", GOOD)])}, 1) == RunMetrics(1, 0, 1)
    assert facts(store) == ["1.json", "2.json", "3.json"]
    assert ledger(store) == [(NAME, f"{n}.json", True) for n in (1, 2, 3)]
    # Everything known: nothing new succeeds, so the archive's row says so.
    ingest(store, {NAME: archive([("1.json", GOOD)])}, 2, "2022-06-02 12:00:00")
    assert zips(store) == [(NAME, True), (NAME, True), (NAME, False)]
    assert len(facts(store)) == 3


def test_failed_document_is_not_retried(store):
    ingest(store, {NAME: archive([("1.json", BAD_JSON)])}, 0)
    ingest(store, {NAME: archive([("1.json", GOOD)])}, 1)
    assert ledger(store) == [(NAME, "1.json", False)] and facts(store) == []


def test_same_document_in_another_archive_is_new(store):
    ingest(store, {"a.zip": archive([("1.json", GOOD)])}, 0)
    ingest(store, {"b.zip": archive([("1.json", GOOD)])}, 1)
    assert facts(store) == ["1.json", "1.json"]
    assert ledger(store) == [("a.zip", "1.json", True), ("b.zip", "1.json", True)]


def test_repeated_batch_replaces_its_output(store):
    content = {DATED: archive([("1.json", GOOD), ("2.json", BAD_DATE)]), "b.zip": archive([])}
    for _ in range(2):
        ingest(store, content, 7)
        assert facts(store) == ["1.json"]
        assert ledger(store) == [(DATED, "1.json", True), (DATED, "2.json", False)]
        assert zips(store) == [("b.zip", False), (DATED, True)]


def outcome(spark, document, name=NAME, json_name="m.json"):
    no_ledger = json_rows(spark, [])
    found = classified(rows_of(spark, {name: [(json_name, document)]}), no_ledger)
    return found.filter("entry_index is not null").first().outcome


@pytest.mark.parametrize(
    "document, expected",
    [
        (GOOD, classify.OK),
        (manifest(VoyageNumber="12A"), classify.BAD_ROW),
        (manifest([], VoyageNumber="12A"), classify.OK),
        (manifest(date="2022-02-30"), classify.BAD_SCHEDULE),
        (manifest(EventCode="DCX"), classify.BAD_ROW),
        # An event code of three letters fits the ledger; only a fact row would not take it.
        (manifest([], EventCode="DCX"), classify.OK),
        (manifest([], EventCode="DCXX"), classify.BAD_ROW),
        (manifest([], CarrierCode="123456"), classify.BAD_ROW),
        (manifest([passenger("1", Age="32768")]), classify.BAD_ROW),
        (manifest([passenger("1", Age="32767")]), classify.OK),
        (manifest([passenger("1" * 26)]), classify.BAD_ROW),
        # Limits concern stored rows: the second passenger is not among the best ones.
        (manifest([passenger("1"), passenger(Age="99999")]), classify.OK),
        (manifest([passenger("1", InTransitFlag="NNN")]), classify.BAD_ROW),
    ],
)
def test_outcomes(spark, document, expected):
    assert outcome(spark, document) == expected


def test_archive_date_outside_the_calendar_fails_its_documents(spark):
    assert outcome(spark, GOOD, name="drt_dq_229901_120000_0001.zip") == classify.BAD_ROW


def test_too_many_passengers_for_a_count(spark):
    people = [passenger("1")] * 32_768
    assert outcome(spark, manifest(people)) == classify.BAD_ROW
    assert outcome(spark, manifest(people[:-1])) == classify.OK


def test_first_occurrence_and_flags(spark):
    entries = spark.createDataFrame(
        [("a", "1", 4), ("a", "1", 2), ("a", "2", 3), ("b", "1", 9)],
        "zip_file_name string, json_file_name string, entry_index bigint",
    )
    recorded = json_rows(spark, [{"zip_file_name": "a", "json_file_name": "2"}] * 2)
    assert sorted(map(tuple, dedupe.first_occurrence(entries).collect())) == [("a", "1", 2), ("a", "2", 3), ("b", "1", 9)]
    assert dedupe.unprocessed(entries, recorded).count() == 3
    flags = dedupe.with_recorded_flag(entries, recorded).filter(F.col("processed")).collect()
    assert [(r.zip_file_name, r.json_file_name) for r in flags] == [("a", "2")]


def test_broken_off_run_is_repeated_without_second_copies(spark, tmp_path, monkeypatch):
    (tmp_path / DATED).write_bytes(archive([("1.json", GOOD), ("2.json", BAD_JSON)]))
    write = Store.write_batch
    for failing in (PASSENGER_FACT, JSON_LEDGER, ZIP_LEDGER, None):
        made = Store(spark, fresh_path(spark, "test-store"))

        def write_and_fail(self, table, rows, batch_id):
            write(self, table, rows, batch_id)
            if table == failing:
                raise RuntimeError(table)

        with monkeypatch.context() as patched:
            patched.setattr(Store, "write_batch", write_and_fail)
            if failing is None:
                patched.setattr(Store, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("commit")))
            with pytest.raises(RuntimeError):
                ingest_new_files(made, str(tmp_path), at("2022-06-01"))
        assert facts(made) == [] and ledger(made) == [] and zips(made) == []
        for _ in range(2):
            ingest_new_files(made, str(tmp_path), at("2022-06-01"))
            assert (facts(made), ledger(made), zips(made)) == (["1.json"], [(DATED, "1.json", True), (DATED, "2.json", False)], [(DATED, True)])


def test_committed_batch_is_not_replaced_by_other_archives(store):
    ingest(store, {DATED: archive([("1.json", GOOD)])}, 0)
    with pytest.raises(ValueError):
        ingest(store, {"other.zip": archive([("1.json", GOOD)])}, 0)
    assert zips(store) == [(DATED, True)]
