"""Ingest of any number of archives as one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from landfall import schema
from landfall.operators import classify, dedupe, rows
from landfall.session import fresh_path, scratch
from landfall.sources import archives, documents, feed, tables
from landfall.sources.tables import Store


@dataclass(frozen=True)
class RunMetrics:
    manifests_processed: int
    zip_failures: int
    zips_processed: int


def classified(
    archive_rows: DataFrame,
    ledger: DataFrame,
    names: DataFrame | None = None,
    exceptions_path: str | None = None,
    needed: Callable[[DataFrame], DataFrame] = lambda assessed: assessed,
) -> DataFrame:
    """Outcome per entry: parsed and judged row by row, then matched with the few pairs that repeat or are
    recorded already.

    Those pairs are found first, from narrow keys, and written. The planner then knows their size: it sends
    them to the documents if they are small, so that no document is shuffled, and else joins by shuffle.
    Rows that carry `occurrence` have had their repeats counted by the source. `needed` leaves of a document what
    its user takes, since all of it is shuffled where the pairs are many.
    """
    recorded = dedupe.recorded_pairs(ledger, names)
    if "occurrence" in archive_rows.columns:
        exceptional = dedupe.recorded_exceptions(recorded)
    else:
        keys = archive_rows.filter(F.col("entry_index").isNotNull()).select(*dedupe.PAIR, "entry_index")
        exceptional = dedupe.exceptions(keys, recorded)
    path = exceptions_path or fresh_path(archive_rows.sparkSession, "exceptions")
    exceptional = tables.written(exceptional, path)
    # The join stands above the parse: a filter on the outcome must not be pushed into it and repeat the parse.
    assessed = needed(classify.assess(documents.parse(archive_rows)))
    return classify.with_outcome(dedupe.mark_processed(assessed, exceptional))


def run_batch(
    store: Store,
    archive_rows: DataFrame,
    names: DataFrame,
    batch_id: int,
    processed_at: Column,
    source: tuple[str, int] | None = None,
) -> RunMetrics:
    """Classify once, then write facts, JSON ledger and zip ledger from the written classification.

    `names` lists the archives in `archive_rows`; it is used instead of the rows themselves so that no
    archive is opened just to look up its name in the ledger. One that gives no rows, since its file is gone or cannot be
    read, is recorded as failed. The batch counts once it is committed, after the three tables. A committed id with the same
    archives is not done again and gives the recorded metrics; with other archives it is refused. Only what committed
    batches recorded counts as processed.
    """
    archives_now = names.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("zip_file_name")), F.lit(0))).first()
    done = store.committed(batch_id)
    if done is not None:
        if (done.archives, done.names) != tuple(archives_now):
            raise ValueError(f"batch {batch_id} is committed already, with other archives")
        return metrics_of(done)
    write_id = store.new_write_id()
    with scratch(store.spark, "ingest") as folder:
        observed = Observation()
        recorded = store.recorded_for(names)
        found = classified(archive_rows, recorded, names, f"{folder}/exceptions", _narrowed)
        staged = tables.written(_staged(found, observed), f"{folder}/classified")
        store.write_batch(tables.PASSENGER_FACT, rows.passenger_facts(staged), write_id)
        store.write_batch(tables.JSON_LEDGER, rows.json_ledger_rows(staged, processed_at), write_id)
        totals, counted = staged, RunMetrics(**observed.get)
        lost = archives_now[0] - counted.zips_processed
        if lost:
            totals = staged.unionByName(tables.written(_unread(names, staged), f"{folder}/unread"), allowMissingColumns=True)
        store.write_batch(tables.ZIP_LEDGER, rows.zip_ledger_rows(rows.zip_totals(totals), processed_at), write_id)
    metrics = RunMetrics(counted.manifests_processed, counted.zip_failures + lost, counted.zips_processed + lost)
    store.commit(batch_id, write_id, *archives_now, (metrics.manifests_processed, metrics.zip_failures, metrics.zips_processed), source)
    return metrics


def metrics_of(commit: Row) -> RunMetrics:
    return RunMetrics(commit.manifests_processed, commit.zip_failures, commit.zips_processed)


def _unread(names: DataFrame, staged: DataFrame) -> DataFrame:
    """Headers of the archives that gave none, one for each time a name is missing."""
    wanted = names.groupBy("zip_file_name").agg(F.count("*").alias("_wanted"))
    given = staged.filter(F.col("entry_index").isNull()).groupBy("zip_file_name").agg(F.count("*").alias("_given"))
    missing = F.col("_wanted") - F.coalesce("_given", F.lit(0))
    lost = wanted.join(given, "zip_file_name", "left").filter(missing > 0)
    return archives.unreadable_headers(lost.select("zip_file_name", F.explode(F.sequence(F.lit(1).cast("long"), missing))))


def ingest_new_files(
    store: Store, path: str, as_of: Column, processed_at: Column | None = None
) -> RunMetrics:
    """One batch of every archive named after the last recorded one (or after the day before `as_of` where
    nothing is recorded), for runs that are scheduled rather than streamed. A run that broke off has recorded
    nothing, so the next one takes its archives and its batch id again."""
    marker = feed.bootstrap_marker(store.read(tables.ZIP_LEDGER), as_of).first().marker
    at = as_of if processed_at is None else processed_at
    files = feed.without_marker(archives.archive_files(store.spark, path, after=marker), marker)
    batch_id = store.last_batch_id() + 1
    metrics = run_batch(store, archives.archive_rows(files), files, batch_id, at)
    store.record_check(at)
    return metrics


def _narrowed(assessed: DataFrame) -> DataFrame:
    """Assessed entries without what the three tables need of no or of another document."""
    voyage = F.struct(*[F.col(f"manifest.{key}") for key in schema.VOYAGE_KEYS])
    carried = [name for name in ("occurrence",) if name in assessed.columns]
    return assessed.select(
        "zip_file_name", "zip_ok", "entry_index", "json_file_name", *carried, "verdict", voyage.alias("manifest"), "scheduled", "voyage_number",
        "created_on", F.when(F.col("verdict") == classify.OK, F.col("best_passengers")).alias("best_passengers"), "best_count", *schema.COUNT_COLUMNS,
    )


def _staged(found: DataFrame, observed: Observation) -> DataFrame:
    """What the three tables need of a classified entry, counted on the way."""
    outcome = F.col("outcome")
    return (
        found.withColumn("best_passengers", F.when(outcome == classify.OK, F.col("best_passengers")))
        .select(
            "zip_file_name", "zip_ok", "entry_index", "json_file_name", "outcome", "manifest",
            "scheduled", "voyage_number", "created_on", "best_passengers", "best_count", *schema.COUNT_COLUMNS,
        )
        .observe(
            observed,
            F.count_if(outcome == classify.OK).alias("manifests_processed"),
            F.count_if(F.col("entry_index").isNull() & ~F.col("zip_ok")).alias("zip_failures"),
            F.count_if(F.col("entry_index").isNull()).alias("zips_processed"),
        )
    )
