"""The bitmap before an exact join: the same rows, and certain newcomers are not shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from landfall.operators import dedupe, probe

PAIRS = "zip_file_name string, json_file_name string"


def pairs(spark, n, start=0):
    return spark.range(start, start + n).selectExpr("concat('z', id % 97) as zip_file_name", "concat('j', id) as json_file_name", "id as entry_index")


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_same_rows_whatever_the_size(spark, monkeypatch, bits):
    """A bitmap that is full sends every row through the join."""
    monkeypatch.setattr(probe, "BITS", bits)
    entries, ledger = pairs(spark, 20_000), pairs(spark, 60_000, 15_000).drop("entry_index")
    assert sorted(r.entry_index for r in dedupe.unprocessed(entries, ledger).collect()) == list(range(15_000))
    flags = dedupe.with_recorded_flag(entries, ledger).groupBy("processed").agg(F.count("*").alias("n"), F.min("entry_index").alias("low")).collect()
    assert {r.processed: (r.n, r.low) for r in flags} == {False: (15_000, 0), True: (5_000, 15_000)}
    plain = entries.join(ledger, dedupe.PAIR, "left_anti")
    assert dedupe.unprocessed(entries, ledger).exceptAll(plain).count() == 0


def test_only_possible_rows_are_joined(spark):
    entries, ledger = pairs(spark, 50_000), pairs(spark, 5_000, 48_000)
    hashed = F.xxhash64(*dedupe.PAIR)
    certain, possible = probe.split(entries, hashed, probe.bitmap(ledger, hashed))
    assert certain.count() + possible.count() == 50_000
    assert 2_000 <= possible.count() < 2_030
    plan = certain._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert probe.bitmap(entries, hashed).count() <= probe.BITS // probe.MAP_BITS


def test_nulls_clashing_names_and_empty_sides(spark):
    rows = spark.createDataFrame([("a", "1", 1, "x"), ("a", None, 2, "y"), (None, None, 3, "z")], PAIRS + ", number int, bits string")
    ledger = spark.createDataFrame([("a", "1"), ("a", None), (None, None)], PAIRS)
    found = dedupe.unprocessed(rows, ledger)
    assert found.columns == rows.columns and sorted(r.number for r in found.collect()) == [2, 3]
    assert dedupe.unprocessed(rows, ledger.limit(0)).count() == 3
    assert dedupe.unprocessed(rows.limit(0), ledger).count() == 0
    dotted = rows.withColumnRenamed("bits", "a.b")
    assert dedupe.with_recorded_flag(dotted, ledger).columns == [*dotted.columns, "processed"]
