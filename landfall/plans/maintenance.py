"""Purge and backfill of the stored tables, rewriting only the partitions they touch. A job that broke off is run again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators import backfill, retention
from landfall.session import scratch
from landfall.sources import tables
from landfall.sources.tables import PARTITIONS, Store


@dataclass(frozen=True)
class PurgeCounts:
    manifests: int = 0
    jsons: int = 0
    zips: int = 0


def _delete(store: Store, table: str, stored: DataFrame, column: str, keys: list[str], folder: str) -> int:
    """Delete rows of `stored`, committed rows of the table, whose `column` is one of few `keys`. Returns how many went.

    The keys are literals, so the scan prunes by them. Only the list of touched partitions comes to the driver.
    """
    if not keys:
        return 0
    hit = F.col(column).isin(keys)
    touched = stored.filter(hit).groupBy(*PARTITIONS).agg(F.count("*").alias("hits"))
    touched = tables.written(touched, f"{folder}/touched-{table}")
    periods = [row[0] for row in touched.select("period").distinct().collect()]
    if not periods:
        return 0
    near = stored.filter(F.col("period").isin(periods)).join(touched.select(*PARTITIONS), PARTITIONS, "left_semi")
    store.rewrite(table, near.filter(~F.coalesce(hit, F.lit(False))).select(*stored.columns), touched, folder)
    return touched.agg(F.sum("hits")).first()[0]


def purge_date(store: Store, date: str, limit: int) -> PurgeCounts:
    """Delete up to `limit` documents of the date from facts and JSON ledger, and the date's archives
    with the last batch. Facts go first: a run that breaks off selects the same names again.

    The ledgers are read in the date's partitions only, but for the deleted names, at most `limit`, which
    the tables are searched for."""
    with scratch(store.spark, "purge") as folder:
        zip_ledger = store.ledger_of_date(tables.ZIP_LEDGER, date).drop(*PARTITIONS)
        json_ledger = store.ledger_of_date(tables.JSON_LEDGER, date).drop(*PARTITIONS)
        names = tables.written(retention.purge_batch(json_ledger, zip_ledger, date, limit), f"{folder}/names")
        closing = retention.closing_date(zip_ledger, names, date, limit).collect()
        keys = [row[0] for row in names.select("json_file_name").distinct().collect()]
        closed = [row.created_on for row in closing]
        facts, jsons = store.partitioned(tables.PASSENGER_FACT), store.partitioned(tables.JSON_LEDGER)
        dated = store.ledger_of_date(tables.ZIP_LEDGER, date)
        return PurgeCounts(
            _delete(store, tables.PASSENGER_FACT, facts, "json_file", keys, folder),
            _delete(store, tables.JSON_LEDGER, jsons, "json_file_name", keys, folder),
            _delete(store, tables.ZIP_LEDGER, dated, "created_on", closed, folder),
        )


def _delete_key(store: Store, table: str, stored: DataFrame, column: str, key: str) -> int:
    with scratch(store.spark, "delete") as folder:
        return _delete(store, table, stored, column, [key], folder)


def delete_facts(store: Store, json_file: str) -> int:
    return _delete_key(store, tables.PASSENGER_FACT, store.partitioned(tables.PASSENGER_FACT), "json_file", json_file)


def delete_json(store: Store, json_file_name: str) -> int:
    return _delete_key(store, tables.JSON_LEDGER, store.partitioned(tables.JSON_LEDGER), "json_file_name", json_file_name)


def delete_zip(store: Store, zip_file_name: str) -> int:
    stored = store.ledger_of_archive(tables.ZIP_LEDGER, zip_file_name)
    return _delete_key(store, tables.ZIP_LEDGER, stored, "zip_file_name", zip_file_name)


def purge_expired(store: Store, as_of: Column, years: int, limit: int) -> PurgeCounts:
    """Purge the oldest date if it is beyond retention, else nothing."""
    target = retention.retention_target(store.read(tables.ZIP_LEDGER), as_of, years).first()
    if target is None or target.purge_date is None:
        return PurgeCounts()
    return purge_date(store, target.purge_date, limit)


def purge_expired_date(store: Store, as_of: Column, years: int, limit: int) -> PurgeCounts:
    """Batches of `limit` documents until the oldest expired date is closed."""
    target = retention.retention_target(store.read(tables.ZIP_LEDGER), as_of, years).first()
    total = PurgeCounts()
    while target is not None and target.purge_date is not None:
        done = purge_date(store, target.purge_date, limit)
        total = PurgeCounts(total.manifests + done.manifests, total.jsons + done.jsons, total.zips + done.zips)
        if done.zips or done == PurgeCounts():
            break
    return total


def backfill_summary(store: Store, date: str | None = None, since: str | None = None) -> int:
    """Recompute the summary columns for one date, or for all from `since` on. Returns rows updated. For one date, only the facts
    of the periods are read that its documents are scheduled in."""
    if date is None:
        ledger, zips, facts = store.partitioned(tables.JSON_LEDGER), store.read(tables.ZIP_LEDGER), store.read(tables.PASSENGER_FACT)
    else:
        ledger = store.ledger_of_date(tables.JSON_LEDGER, date)
        zips = store.ledger_of_date(tables.ZIP_LEDGER, date).drop(*PARTITIONS)
        facts = store.facts_of(backfill.rows_to_update(ledger, zips, date, since)).drop(*PARTITIONS)
    with scratch(store.spark, "backfill") as folder:
        updated = tables.written(
            backfill.updated_rows(ledger, zips, facts, date, since), f"{folder}/updated"
        )
        touched = updated.select(*PARTITIONS).distinct()
        archives = updated.select("zip_file_name").distinct()
        others = ledger.join(touched, PARTITIONS, "left_semi").join(archives, "zip_file_name", "left_anti")
        changed = updated.count()
        if changed:
            store.rewrite(tables.JSON_LEDGER, updated.unionByName(others).select(*ledger.columns), touched, folder)
        return changed


def backfill_created_on(store: Store) -> int:
    """Fill missing archive dates where the name holds one. Returns rows updated."""
    zips = store.partitioned(tables.ZIP_LEDGER)
    filled = F.col("created_on").isNull() & F.col("filled_on").isNotNull()
    with scratch(store.spark, "created-on") as folder:
        candidates = backfill.with_created_on(zips.withColumn("was", F.col("created_on"))).select(
            *[c for c in zips.columns if c != "created_on"],
            F.col("was").alias("created_on"),
            F.col("created_on").alias("filled_on"),
        )
        touched = tables.written(
            candidates.filter(filled).groupBy(*PARTITIONS).agg(F.count("*").alias("changed")),
            f"{folder}/touched",
        )
        rewritten = candidates.join(touched.select(*PARTITIONS), PARTITIONS, "left_semi").withColumn(
            "created_on", F.coalesce("created_on", "filled_on")
        )
        changed = touched.agg(F.coalesce(F.sum("changed"), F.lit(0))).first()[0]
        if changed:
            store.rewrite(tables.ZIP_LEDGER, rewritten.select(*zips.columns), touched, folder)
        return changed

