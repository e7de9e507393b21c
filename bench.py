"""Headline queries at one scale, as one JSON line. Deriving the manifests from the tables, writing the stored
tables by two ingest jobs and writing the zip files are timed on their own, as `derive_archives`, `ingest_jobs` and
`write_zips`; the stream over the files and the jobs on the stored tables come last, since they change them."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures import archives, queries as registry  # noqa: E402
from fixtures.views import inputs, stored  # noqa: E402
from landfall.plans import maintenance  # noqa: E402

HEADLINE = [
    "parse_manifest", "classify_outcome", "ingest_batch", "passenger_fact", "json_ledger", "zip_totals", "zip_scan",
    "first_occurrence", "unprocessed_entries", "json_with_zip", "manifest_counts", "backfill_summary",
    "earliest_unpopulated", "duplicate_ledger_rows", "purge_batch", "purge_remaining_fact",
    "purge_remaining_json", "purge_remaining_zip", "purge_counts", "document_age_lookup",
    "pipeline_freshness",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("landfall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="landfall-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("derive_archives", lambda: inputs(spark, sf_dir))
    timed("ingest_jobs", lambda: stored(spark, sf_dir))
    timed("write_zips", lambda: archives.drop_folder(spark, sf_dir))
    known = registry.registered()
    for name in HEADLINE:
        timed(
            name,
            lambda: known[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    timed("stream_ingest", lambda: archives.streamed(spark, sf_dir))
    timed("purge_date_job", lambda: maintenance.purge_date(stored(spark, sf_dir), registry.PURGE_DATE, registry.FULL_BATCH))
    timed("backfill_job", lambda: maintenance.backfill_summary(stored(spark, sf_dir), since=registry.SINCE))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
