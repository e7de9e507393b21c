from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall import schema
from landfall.operators import backfill, quality, retention
from landfall.plans.maintenance import (
    PurgeCounts,
    backfill_created_on,
    backfill_summary,
    delete_facts,
    delete_json,
    delete_zip,
    purge_date,
    purge_expired,
    purge_expired_date,
)
from landfall.session import fresh_path
from landfall.sources import feed
from landfall.sources.tables import JSON_LEDGER, PASSENGER_FACT, ZIP_LEDGER, Store
from samples import at, fact_rows, json_rows, zip_rows

ZIP = {day: f"drt_dq_21010{day}_144059_636{day}.zip" for day in (1, 2, 3)}
DAY = {day: f"2021-01-0{day}" for day in (1, 2, 3)}


def voyage_of(row):
    return tuple(row[c] for c in schema.VOYAGE_COLUMNS)


def counts_of(row):
    return tuple(row[c] for c in schema.COUNT_COLUMNS)


def test_backfill_from_facts(spark):
    ledger = json_rows(spark, [{"zip_file_name": ZIP[1], "json_file_name": "a"}])
    archives = zip_rows(spark, [(ZIP[1], DAY[1])])
    facts = fact_rows(spark, [{"json_file": "a"}, {"json_file": "b"}])
    row = backfill.updated_rows(ledger, archives, facts, DAY[1]).first()
    assert voyage_of(row) == ("LHR", "JFK", 1000, "BA", datetime(2024, 4, 22, 10, 30), "DC")
    assert counts_of(row) == (0, 0, 1, 0)


def test_backfill_without_facts(spark):
    ledger = json_rows(spark, [{"zip_file_name": ZIP[1], "json_file_name": "a", "voyage_number": 7}])
    row = backfill.updated_rows(ledger, zip_rows(spark, [(ZIP[1], DAY[1])]), fact_rows(spark, []), DAY[1]).first()
    assert voyage_of(row) == (None,) * 6 and counts_of(row) == (0, 0, 0, 0)


def test_backfill_of_a_document_in_two_archives(spark):
    ledger = json_rows(spark, [{"zip_file_name": ZIP[d], "json_file_name": "a"} for d in (1, 2)])
    archives = zip_rows(spark, [(ZIP[1], DAY[1]), (ZIP[2], DAY[2])])
    found = backfill.updated_rows(ledger, archives, fact_rows(spark, [{"json_file": "a"}]), since=DAY[1]).collect()
    assert [counts_of(r) for r in found] == [(0, 0, 1, 0)] * 2
    only = backfill.updated_rows(ledger, archives, fact_rows(spark, [{"json_file": "a"}]), DAY[2]).collect()
    assert [r.zip_file_name for r in only] == [ZIP[2]]


def test_backfill_multiplies_by_repeated_ledger_rows_only(spark):
    """A pair recorded twice counts twice; an archive recorded twice does not."""
    ledger = json_rows(spark, [{"zip_file_name": ZIP[1], "json_file_name": "a"}] * 2)
    archives = zip_rows(spark, [(ZIP[1], DAY[1])] * 3)
    facts = fact_rows(spark, [{"json_file": "a", "passenger_identifier": "", "in_transit": True}] * 2)
    found = backfill.updated_rows(ledger, archives, facts, DAY[1]).collect()
    assert [counts_of(r) for r in found] == [(4, 4, 0, 0)] * 2


def test_backfill_takes_the_smallest_voyage_nulls_last(spark):
    ledger = json_rows(spark, [{"zip_file_name": ZIP[1], "json_file_name": "a"}])
    facts = fact_rows(spark, [
        {"json_file": "a", "arrival_port_code": None},
        {"json_file": "a", "arrival_port_code": "STN"},
        {"json_file": "a", "arrival_port_code": "MAN", "voyage_number": None},
        {"json_file": "a", "arrival_port_code": "MAN", "voyage_number": 9},
    ])
    row = backfill.updated_rows(ledger, zip_rows(spark, [(ZIP[1], DAY[1])]), facts, DAY[1]).first()
    assert (row.arrival_port_code, row.voyage_number) == ("MAN", 9)


def test_earliest_unpopulated(spark):
    filled = {c: 1 for c in schema.COUNT_COLUMNS}
    ledger = json_rows(spark, [
        {"zip_file_name": ZIP[1], "json_file_name": "a"},
        {"zip_file_name": ZIP[2], "json_file_name": "b"} | filled,
        {"zip_file_name": ZIP[3], "json_file_name": "c", "success": False},
    ])
    archives = zip_rows(spark, [(ZIP[d], DAY[d]) for d in (1, 2, 3)])

    def earliest(since, zips=archives):
        return backfill.earliest_unpopulated(ledger, zips, since).first()[0]

    assert earliest("2020-12-31") == DAY[1] and earliest(DAY[1]) == DAY[1]
    assert earliest(DAY[2]) is None
    assert earliest(DAY[1], zip_rows(spark, [(ZIP[1], DAY[1])], success=False)) is None


def test_created_on_is_filled_where_missing(spark):
    zips = zip_rows(spark, [(ZIP[1], None), (ZIP[2], "1999-01-01"), ("legacy.zip", None)])
    found = {r.zip_file_name: r.created_on for r in backfill.with_created_on(zips).collect()}
    assert found == {ZIP[1]: DAY[1], ZIP[2]: "1999-01-01", "legacy.zip": None}


def test_duplicates_count_like_the_join(spark):
    ledger = json_rows(spark, [{"zip_file_name": z, "json_file_name": "a"} for z in (ZIP[1], ZIP[1], ZIP[2])]
                       + [{"zip_file_name": ZIP[3], "json_file_name": "b"}])
    archives = zip_rows(spark, [(ZIP[1], DAY[1])] * 2 + [(ZIP[2], DAY[2]), (ZIP[3], DAY[3])])
    report = lambda date=None: [(r.json_file_name, r.dupes) for r in
                                quality.duplicate_ledger_rows(ledger, archives, date).collect()]
    assert report() == [("a", 5)]
    assert report(DAY[1]) == [("a", 4)]
    assert report(DAY[3]) == []


@pytest.mark.parametrize("seconds, healthy", [(299, True), (300, True), (301, False)])
def test_freshness(spark, seconds, healthy):
    zips = zip_rows(spark, [(ZIP[1], DAY[1])])
    now = F.timestamp_seconds(F.unix_seconds(at("2021-01-01")) + seconds)
    assert quality.freshness(zips, now, [300]).first().healthy is healthy


def test_never_processed_is_not_fresh(spark):
    assert quality.freshness(zip_rows(spark, []), at("2021-01-01"), [300]).first().healthy is False


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "zip_file_name string")


def test_feed(spark):
    listing = names(spark, "c.zip", "a.zip", "b.zip", "b.zip.bak")
    after = [r[0] for r in feed.list_after(listing, "a.zip").collect()]
    assert after == ["b.zip", "b.zip.bak", "c.zip"]
    assert feed.next_marker(listing, "a.zip").first()[0] == "c.zip"
    assert {r[0] for r in feed.without_marker(listing, "b.zip").collect()} == {"a.zip", "c.zip"}
    assert feed.without_marker(listing, "").count() == 4
    assert feed.next_marker(names(spark, "b.zip"), "b.zip").first()[0] == "b.zip"


def test_bootstrap(spark):
    zips = zip_rows(spark, [(ZIP[1], DAY[1]), ("zzz.zip", None)], success=False)
    assert feed.bootstrap_marker(zips, at("2021-01-01")).first()[0] == "zzz.zip"
    empty = feed.bootstrap_marker(zip_rows(spark, []), at("2021-01-01")).first()[0]
    assert empty == "drt_dq_201231_000000_0000.zip"


def test_retention_target(spark):
    def target(rows, as_of="2022-06-01", years=1):
        return retention.retention_target(zip_rows(spark, rows), at(as_of), years).first().purge_date

    rows = [(ZIP[2], DAY[2]), (ZIP[1], DAY[1]), ("legacy.zip", None)]
    assert target(rows) == DAY[1]
    assert target(rows, "2021-12-31") is None
    assert target([("legacy.zip", None)]) is None
    assert target([]) is None
    # An oldest date that is no date stops purging.
    assert target(rows + [("x.zip", "2000-99-99")]) is None


@pytest.fixture
def store(spark):
    """Three days; the second has three documents, one of them also delivered on the third."""
    made = Store(spark, fresh_path(spark, "test-store"))
    documents = [(1, "1a"), (2, "2a"), (2, "2b"), (2, "2c"), (3, "3a"), (3, "2a")]
    made.write_batch(JSON_LEDGER, json_rows(spark, [
        {"zip_file_name": ZIP[d], "json_file_name": j} for d, j in documents
    ]), 0)
    made.write_batch(ZIP_LEDGER, zip_rows(spark, [(ZIP[d], DAY[d]) for d in (1, 2, 3)]), 0)
    made.write_batch(PASSENGER_FACT, fact_rows(spark, [
        {"json_file": j, "scheduled_date": datetime(2021, 1, d)} for d, j in documents
    ]), 0)
    made.commit(0)
    return made


def content(store):
    return (
        sorted(r.json_file for r in store.read(PASSENGER_FACT).collect()),
        sorted((r.zip_file_name, r.json_file_name) for r in store.read(JSON_LEDGER).collect()),
        sorted(r.zip_file_name for r in store.read(ZIP_LEDGER).collect()),
    )


def test_purge_in_batches(store):
    assert purge_date(store, DAY[2], 2) == PurgeCounts(3, 3, 0)
    assert content(store) == (
        ["1a", "2c", "3a"], [(ZIP[1], "1a"), (ZIP[2], "2c"), (ZIP[3], "3a")], [ZIP[1], ZIP[2], ZIP[3]],
    )
    assert purge_date(store, DAY[2], 2) == PurgeCounts(1, 1, 1)
    assert content(store) == (["1a", "3a"], [(ZIP[1], "1a"), (ZIP[3], "3a")], [ZIP[1], ZIP[3]])
    assert purge_date(store, DAY[2], 2) == PurgeCounts(0, 0, 0)


def test_purge_of_exactly_the_limit_leaves_the_archive(store):
    assert purge_date(store, DAY[2], 3) == PurgeCounts(4, 4, 0)
    assert purge_date(store, DAY[2], 3) == PurgeCounts(0, 0, 1)


def test_purge_expired(store):
    assert purge_expired(store, at("2021-12-31"), 1, 500) == PurgeCounts(0, 0, 0)
    assert purge_expired(store, at("2022-06-01"), 1, 500) == PurgeCounts(1, 1, 1)
    assert content(store)[2] == [ZIP[2], ZIP[3]]


def test_purge_of_empty_tables(spark):
    assert purge_expired(Store(spark, fresh_path(spark, "none")), at("2022-06-01"), 1, 5) == PurgeCounts()


def test_backfill_job_keeps_other_rows(store):
    assert backfill_summary(store, date=DAY[2]) == 3
    found = {(r.zip_file_name, r.json_file_name): counts_of(r) for r in store.read(JSON_LEDGER).collect()}
    assert len(found) == 6
    # The document delivered twice has facts of two voyages; the first of them counts.
    assert found[(ZIP[2], "2a")] == (0, 0, 1, 0) and found[(ZIP[2], "2b")] == (0, 0, 1, 0)
    assert found[(ZIP[3], "2a")] == (None,) * 4 and found[(ZIP[1], "1a")] == (None,) * 4
    assert backfill_summary(store, since=DAY[1]) == 6
    assert backfill_summary(store, date="1999-01-01") == 0


def test_deletes(spark):
    facts = fact_rows(spark, [{"json_file": "a"}, {"json_file": "b"}, {"json_file": None}])
    assert [r.json_file for r in retention.without_key(facts, "json_file", "a").collect()] == ["b", None]
    gone = names(spark).selectExpr("zip_file_name as json_file_name")
    assert retention.remaining_facts(facts, gone).count() == 3
    gone = names(spark, "b", "b").selectExpr("zip_file_name as json_file_name")
    assert retention.remaining_facts(facts, gone).count() == 2


def test_lookups(spark):
    facts = fact_rows(spark, [{}, {"week_of_year": 18}, {"day_of_week": 2}, {"age": 5}])
    assert quality.route_week(facts, "DC", "LHR", "JFK", 17).count() == 3
    assert quality.route_week(facts, "DC", "LHR", "JFK", 17, 1).count() == 2
    assert quality.document_age(facts, "DC", "LHR", "P", "GBR", 18).count() == 3
    ledger = json_rows(spark, [
        {"arrival_port_code": "LHR", "event_code": "DC", "scheduled": datetime(2024, 4, day, 23, 59)} for day in (21, 22)
    ])
    row = quality.arrivals(ledger, "LHR", "2024-04-22", "DC").first()
    assert (str(row.scheduled_on), row.day_of_week, row.week, row.year) == ("2024-04-22", 1, 17, 2024)


def test_delete_jobs(store):
    assert delete_facts(store, "2a") == 2 and delete_facts(store, "2a") == 0
    assert delete_json(store, "1a") == 1
    assert delete_zip(store, ZIP[3]) == 1 and delete_zip(store, "none.zip") == 0
    assert content(store) == (
        ["1a", "2b", "2c", "3a"],
        [(ZIP[2], "2a"), (ZIP[2], "2b"), (ZIP[2], "2c"), (ZIP[3], "2a"), (ZIP[3], "3a")],
        [ZIP[1], ZIP[2]],
    )


def test_created_on_job(spark):
    made = Store(spark, fresh_path(spark, "test-store"))
    made.write_batch(ZIP_LEDGER, zip_rows(spark, [(ZIP[1], None), (ZIP[2], "1999-01-01"), ("legacy.zip", None)]), 0)
    made.commit(0)
    assert backfill_created_on(made) == 1
    found = {r.zip_file_name: r.created_on for r in made.read(ZIP_LEDGER).collect()}
    assert found == {ZIP[1]: DAY[1], ZIP[2]: "1999-01-01", "legacy.zip": None}
    assert backfill_created_on(made) == 0


def test_purge_until_the_date_is_closed(store):
    assert purge_expired_date(store, at("2021-12-31"), 1, 2) == PurgeCounts()
    assert purge_expired_date(store, at("2022-06-01"), 1, 1) == PurgeCounts(1, 1, 1)
    assert purge_date(store, DAY[2], 500) == PurgeCounts(4, 4, 1)


def test_rewrite_broken_off_is_run_again(store, monkeypatch):
    """A job that broke off between its steps is run again: rows are neither lost nor doubled."""
    whole = content(store)
    for step in ("replace_partitions", "_drop_partitions"):
        with monkeypatch.context() as patched, pytest.raises(RuntimeError):
            def fail(*_):
                raise RuntimeError(step)

            patched.setattr(Store, step, fail)
            delete_json(store, "1a")
        assert content(store) == whole
    assert delete_json(store, "1a") == 1
    assert content(store)[1] == [d for d in whole[1] if d[1] != "1a"]


def test_purge_broken_off_after_the_facts_is_completed(store, monkeypatch):
    replace = Store.replace_partitions

    def fail(self, table, rows):
        if table != PASSENGER_FACT:
            raise RuntimeError(table)
        replace(self, table, rows)

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(Store, "replace_partitions", fail)
        purge_date(store, DAY[2], 500)
    assert purge_date(store, DAY[2], 500) == PurgeCounts(0, 4, 1)
    assert content(store) == (["1a", "3a"], [(ZIP[1], "1a"), (ZIP[3], "3a")], [ZIP[1], ZIP[3]])


def test_rows_of_batches_that_were_not_committed_are_not_seen(store):
    before = content(store)
    store.write_batch(JSON_LEDGER, json_rows(store.spark, [{"zip_file_name": ZIP[1], "json_file_name": "left"}]), store.new_write_id())
    assert content(store) == before
    assert delete_json(store, "left") == 0 and delete_json(store, "1a") == 1
    assert store.last_batch_id() == 0 and store.committed(1) is None


def _scheduled(store, by_day):
    """The ledger of `store` with the dates its documents are scheduled on."""
    rows = store.partitioned(JSON_LEDGER)
    day = F.create_map(*[x for name, d in by_day.items() for x in (F.lit(name), F.lit(d))])[F.col("json_file_name")]
    return rows.withColumn("scheduled", F.to_timestamp(day))


def test_backfill_of_one_date_reads_the_facts_of_its_periods(store, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    names = spark.createDataFrame([("1a",), ("2b",)], "json_file_name string")
    assert store.facts_of(names).count() == store.read(PASSENGER_FACT).count()  # dates are not known yet: all periods
    path = fresh_path(spark, "scheduled")
    _scheduled(store, {"1a": DAY[1], "2a": DAY[2], "2b": DAY[2], "2c": DAY[2], "3a": DAY[3]}).write.parquet(path)
    store.replace_partitions(JSON_LEDGER, spark.read.parquet(path))
    found = store.facts_of(names)
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "PartitionFilters: [period" in plan and DAY[3] not in plan
    assert sorted(r.json_file for r in found.collect()) == ["1a", "2a", "2b", "2c"]
    assert backfill_summary(store, date=DAY[2]) == 3
    counts = {(r.zip_file_name, r.json_file_name): counts_of(r) for r in store.read(JSON_LEDGER).collect()}
    assert counts[(ZIP[2], "2b")] == (0, 0, 1, 0)
