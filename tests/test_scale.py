"""Shapes that matter with large tables: heavy keys, and plans that read and parse only what they need."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from fixtures import archives, oracle
from fixtures import queries as registry
from fixtures.views import Fixture
from landfall.operators import dedupe, quality, rows
from landfall.plans.ingest import classified
from landfall.session import fresh_path
from samples import json_rows, zip_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def heavy_dir(tmp_path_factory):
    """The small tables with a third of all lines moved to one order."""
    folder = tmp_path_factory.mktemp("heavy")
    with duckdb.connect() as connection:
        for name in ("region", "nation", "customer", "supplier", "orders"):
            connection.execute(
                f"COPY (SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')) TO '{folder}/{name}.parquet'"
            )
        connection.execute(
            f"""COPY (SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 58 ELSE l_orderkey END AS l_orderkey)
            FROM read_parquet('{SF_DIR}/lineitem.parquet')) TO '{folder}/lineitem.parquet'"""
        )
    return str(folder)


def test_heavy_order_is_split_into_documents(spark, heavy_dir):
    fixture = Fixture(spark, heavy_dir)
    lists = fixture.passenger_lists().filter("k = 58").select(F.size("passengers").alias("n")).collect()
    assert len(lists) > 3 and max(r.n for r in lists) < 2 * fixture.lines_per_document
    names = fixture.keyed_entries().filter("k = 58 and not repeat and not second")
    assert names.select("zip_file_name").distinct().count() == len(lists)


@pytest.mark.parametrize("lines", [500, 3])
def test_split_documents_match_sql(spark, heavy_dir, lines):
    fixture = Fixture(spark, heavy_dir, lines)
    connection, sql = compare.connect(heavy_dir), oracle.oracle_sql(lines)
    nothing = spark.createDataFrame([], "zip_file_name string, json_file_name string")
    found = classified(fixture.archive_rows().drop("prior"), nothing)
    assert compare.differences(rows.passenger_facts(found), connection, sql["passenger_fact"]) == ""
    assert compare.differences(rows.zip_totals(found), connection, sql["zip_totals"]) == ""


def test_archives_of_a_heavy_order_stay_small(spark, heavy_dir):
    sizes = archives.zipped(Fixture(spark, heavy_dir, 3).archive_rows()).select(F.length("content")).agg(F.max("length(content)"))
    assert sizes.first()[0] < 100_000


def test_one_pair_with_most_rows(spark):
    """Half of all entries share one archive and name: grouped before the shuffle, result unchanged."""
    entries = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "hot.zip").otherwise(F.concat(F.lit("z"), F.col("id").cast("string"))).alias("zip_file_name"),
        F.lit("a.json").alias("json_file_name"),
        F.col("id").alias("entry_index"),
    )
    firsts = dedupe.first_occurrence(entries)
    assert firsts.count() == 10_001
    assert firsts.filter("zip_file_name = 'hot.zip'").first().entry_index == 0
    marked = dedupe.mark_processed(entries, dedupe.exceptions(entries, entries.limit(0)))
    assert marked.filter("already_processed").count() == 9_999
    plan = firsts._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "partial_min" in plan


def test_one_archive_recorded_often(spark):
    """Counts stand for the joined rows, which are never made."""
    ledger = json_rows(spark, [{"zip_file_name": "hot.zip", "json_file_name": "a"}]).crossJoin(
        spark.range(3_000).select()
    )
    zips = zip_rows(spark, [("hot.zip", "2021-01-01")]).crossJoin(spark.range(2_000).select())
    assert quality.duplicate_ledger_rows(ledger, zips).first().dupes == 6_000_000


def physical(frame):
    return frame._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize(
    "name",
    [
        "parse_manifest", "ingest_batch", "passenger_fact", "json_ledger", "zip_ledger", "classify_outcome",
        "quarantine_json", "suspicious_date", "ingest_counts", "zip_totals", "best_passengers",
        "interactive_passengers", "non_interactive_passengers", "has_interactive", "age_or_default",
        "schema_limit_violations", "zip_scan", "scheduled_ts", "voyage_number",
    ],
)
def test_documents_are_parsed_once(spark, name):
    plan = physical(registry.registered()[name](spark, SF_DIR))
    assert plan.count("from_json(") == 1


def test_no_pairwise_joins_anywhere(spark):
    for name, query in registry.registered().items():
        plan = physical(query(spark, SF_DIR))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), name


@pytest.mark.parametrize("name", ["purge_batch", "backfill_one_date", "duplicate_ledger_rows_for_date"])
def test_one_date_reads_its_own_partitions(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = physical(registry.registered()[name](spark, SF_DIR))
    assert "PartitionFilters" in plan and "period" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_deleted_keys_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = physical(registry.json_ledger(spark, SF_DIR).filter(F.col("json_file_name").isin(["m_58.json"])))
    assert "EqualTo(json_file_name,m_58.json)" in plan or "In(json_file_name, [m_58.json])" in plan


def test_filters_and_columns_reach_the_stored_tables(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = physical(registry.document_age_lookup(spark, SF_DIR))
    assert "EqualTo(arrival_port_code,LHR)" in plan and "GreaterThanOrEqual(age,30)" in plan
    plan = physical(registry.oldest_date(spark, SF_DIR))
    assert "ReadSchema: struct<created_on:string>" in plan


def test_ledger_probe_reads_only_the_periods_of_the_batch(spark):
    from landfall.sources.tables import JSON_LEDGER, Store

    store = Store(spark, fresh_path(spark, "periods"))
    names = [f"drt_dq_21010{day}_000000_0000.zip" for day in range(1, 6)]
    store.write_batch(JSON_LEDGER, json_rows(spark, [{"zip_file_name": n, "json_file_name": "a"} for n in names]), 0)
    assert store.recorded_for(zip_rows(spark, [(names[3], None)])).count() == 0
    store.commit(0)
    found = store.recorded_for(zip_rows(spark, [(names[3], None), ("legacy.zip", None)]))
    assert [r.zip_file_name for r in found.collect()] == [names[3]]
    assert "PartitionFilters: [period" in physical(found)
