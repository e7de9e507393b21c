"""What writes leave on the disk."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from fixtures.views import Fixture
from landfall import schema
from landfall.operators import classify
from landfall.plans.ingest import _narrowed
from landfall.session import fresh_path
from landfall.sources import documents, tables
from landfall.sources.tables import JSON_LEDGER, Store
from samples import json_rows, manifest, passenger, rows_of
from test_scale import SF_DIR, physical


def test_filters_of_few_names_are_small(spark):
    """A filter was a megabyte for each column of each file, and still tells which names are there."""
    store = Store(spark, fresh_path(spark, "small"))
    store.write_batch(JSON_LEDGER, json_rows(spark, [{"zip_file_name": "drt_dq_210101_000000_0000.zip", "json_file_name": f"{i}.json"} for i in range(100)]), 0)
    store.commit(0)
    files = list(Path(store.path(JSON_LEDGER).removeprefix("file:")).rglob("*.parquet"))
    assert files and max(file.stat().st_size for file in files) < 100_000
    assert store.read(JSON_LEDGER).filter("json_file_name = '7.json'").count() == 1


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_to = _shuffle_files(spark), spark.conf.get(key)
    kept = tables.written(spark.range(10_000).withColumn("k", F.col("id") % 7).repartition("id").groupBy("k").count(), fresh_path(spark, "kept"))
    until = time.monotonic() + 20
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert kept.count() == 7 and spark.conf.get(key) == set_to


def test_a_batch_shuffles_what_its_tables_need(spark):
    """Passengers of documents that fail, and the list they were chosen from, are not carried to the join."""
    good = manifest([passenger("1"), passenger("")])
    entries = rows_of(spark, {"a.zip": [("1.json", good), ("2.json", good | {"ScheduledDateOfArrival": "x"})]})
    found = _narrowed(classify.assess(documents.parse(entries)))
    assert found.schema["manifest"].dataType.fieldNames() == schema.VOYAGE_KEYS
    carried = {r.json_file_name: (r.verdict, r.best_passengers and [p.PassengerIdentifier for p in r.best_passengers]) for r in found.collect() if r.json_file_name}
    assert carried == {"1.json": (classify.OK, ["1"]), "2.json": (classify.BAD_SCHEDULE, None)}


def test_passengers_are_made_after_the_shuffle(spark):
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        plan = physical(Fixture(spark, SF_DIR).passenger_lists())
    finally:
        spark.conf.set(key, before)
    assert "struct(l_linenumber" in plan.split("Exchange", 1)[1] and "DocumentIssuingCountryCode" not in plan
